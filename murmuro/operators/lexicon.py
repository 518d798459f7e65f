"""Lexicon scoring: sentiment, subjectivity, emotion. Lexicons are tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import tokens
from murmuro.runtime import fixed_table, lookup_join, n_rows, top, unnest

PUNCTUATION_EDGES = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"


def label_by(score: Column, cut: float) -> Column:
    return F.when(score >= cut, "positive").when(score <= -cut, "negative").otherwise("neutral")


def attach(df: DataFrame, scores: DataFrame, order_key: str, defaults: dict[str, object]) -> DataFrame:
    """Left-join per-comment scores by id; comments without a hit get the defaults."""
    joined = df.join(scores, order_key, "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(value)) for name, value in defaults.items()})


# Rule-based sentiment


def _is_caps(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _word_with_context(c: Column) -> Column:
    """Each white-space word (edge punctuation cut unless little remains) with the three words before it."""

    def trimmed(w: Column) -> Column:
        cut = F.regexp_replace(w, PUNCTUATION_EDGES, "")
        return F.when(F.length(cut) <= 2, w).otherwise(cut)

    words = F.transform(F.regexp_extract_all(c, F.lit(r"\S+"), 0), trimmed)
    return words


def _booster(previous: Column, valence: Column, mixed: Column) -> Column:
    lowered = F.lower(previous)
    size = (
        F.when(lowered.isin(fixed.BOOSTERS_UP), fixed.BOOST_UP)
        .when(lowered.isin(fixed.BOOSTERS_DOWN), fixed.BOOST_DOWN)
        .otherwise(0.0)
    )
    signed = F.when(valence < 0, -size).otherwise(size)
    louder = F.when((size != 0) & mixed & _is_caps(previous), F.lit(fixed.CAPS_BOOST)).otherwise(0.0)
    return signed + F.when(valence > 0, louder).otherwise(-louder)


def _negates(word: Column) -> Column:
    return F.lower(word).isin(fixed.NEGATORS) | F.lower(word).contains("n't")


def rule_sentiment(df: DataFrame, lexicon: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(order key, score): compound valence in [-1, 1] of each comment with a lexicon hit.

    Every word carries its three predecessors out of the row, so only lexicon hits are
    kept after one lookup and no window over tokens is needed.
    """
    base = df.select(order_key, "text", _word_with_context(F.col("text")).alias("words"))
    lowered = F.transform("words", F.lower)
    caps = F.exists("words", _is_caps)
    base = base.select(
        order_key,
        "words",
        (caps & F.exists("words", lambda w: ~_is_caps(w))).alias("mixed"),
        F.array_position(lowered, "but").alias("but_at"),
        F.least(F.regexp_count("text", F.lit("!")), F.lit(4)).alias("bangs"),
        F.regexp_count("text", F.lit(r"\?")).alias("asks"),
    )
    gap = F.array(F.lit(None).cast("string"))
    shifted = [F.col("words").alias("w")]
    for i in (1, 2, 3):
        shifted.append(F.concat(*[gap] * i, F.col("words")).alias(f"p{i}"))
    kept = [order_key, "mixed", "but_at", "bangs", "asks"]
    rows = unnest(base, F.arrays_zip(*shifted), "z", *kept, pos="pos").select(order_key, "mixed", "but_at", "bangs", "asks", "pos", "z.w", "z.p1", "z.p2", "z.p3")
    rows = rows.where(F.col("w").isNotNull() & ~F.lower("w").isin([*fixed.BOOSTERS_UP, *fixed.BOOSTERS_DOWN]))
    rows = rows.withColumn("word", F.lower("w"))
    hits = lookup_join(rows, lexicon.select("word", "valence"), "word")
    for i in (1, 2, 3):
        known = lexicon.select(F.col("word").alias(f"_p{i}"), F.lit(True).alias(f"known{i}"))
        hits = lookup_join(hits.withColumn(f"_p{i}", F.lower(f"p{i}")), known, f"_p{i}", "left")
    v = F.when(
        F.col("mixed") & _is_caps(F.col("w")),
        F.col("valence") + F.signum("valence") * fixed.CAPS_BOOST,
    ).otherwise(F.col("valence"))
    intensified = {1: F.lower("p1").isin("so", "this"), 2: F.lower("p2").isin("so", "this")}
    doubt = {1: F.lower("p1") == "doubt", 2: F.lower("p2") == "doubt"}
    for i, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
        p = F.col(f"p{i}")
        free = p.isNotNull() & F.col(f"known{i}").isNull()
        boosted = v + _booster(p, v, F.col("mixed")) * damping
        turned = F.when(_negates(p), boosted * fixed.NEGATION).otherwise(boosted)
        if i > 1:
            near = intensified[1] if i == 2 else intensified[1] | F.coalesce(intensified[2], F.lit(False))
            sure = doubt[1] if i == 2 else doubt[1] | F.coalesce(doubt[2], F.lit(False))
            turned = (
                F.when((F.lower(p) == "never") & near, boosted * 1.25)
                .when((F.lower(p) == "without") & sure, boosted)
                .otherwise(turned)
            )
        v = F.when(free, turned).otherwise(v)
        hits = hits.withColumn(f"v{i}", v)
        v = F.col(f"v{i}")
    at = F.col("pos") + 1
    weighted = (
        F.when((F.col("but_at") > 0) & (at < F.col("but_at")), v * fixed.BEFORE_BUT)
        .when((F.col("but_at") > 0) & (at > F.col("but_at")), v * fixed.AFTER_BUT)
        .otherwise(v)
    )
    sums = hits.groupBy(order_key).agg(
        F.sum(weighted).alias("s"), F.max("bangs").alias("bangs"), F.max("asks").alias("asks")
    )
    asked = (
        F.when(F.col("asks") > 3, fixed.MANY_QUESTIONS)
        .when(F.col("asks") > 1, F.col("asks") * fixed.QUESTION)
        .otherwise(0.0)
    )
    emphasis = F.col("bangs") * fixed.EXCLAMATION + asked
    s = F.round("s", 9)
    total = F.when(s > 0, s + emphasis).when(s < 0, s - emphasis).otherwise(F.lit(0.0))
    compound = total / F.sqrt(total * total + fixed.NORMALISER)
    return sums.select(order_key, F.round(compound, 4).alias("score"))


# Polarity and subjectivity


def polarity(df: DataFrame, lexicon: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(order key, polarity, subjectivity): means over the lexicon hits of each comment that has any."""
    rows = unnest(df, tokens.words(F.col("text")), "word", order_key)
    hits = lookup_join(rows, lexicon.select("word", "polarity", "subjectivity"), "word")
    return hits.groupBy(order_key).agg(
        F.round(F.avg("polarity"), 9).alias("polarity"), F.round(F.avg("subjectivity"), 9).alias("subjectivity")
    )


def with_polarity(df: DataFrame, lexicon: DataFrame, order_key: str = "doc_id") -> DataFrame:
    return attach(df, polarity(df, lexicon, order_key), order_key, {"polarity": 0.0, "subjectivity": 0.0})


def with_sentiment(
    df: DataFrame,
    method: str,
    lexicon: DataFrame | None = None,
    model=None,
    order_key: str = "doc_id",
) -> DataFrame:
    """Attach `sentiment` and `sentiment_score`.

    Methods: `rules` (valence lexicon), `polarity` (polarity lexicon), `model` (a fitted
    classifier with string labels).
    """
    if method == "rules":
        scored = attach(df, rule_sentiment(df, lexicon, order_key), order_key, {"score": 0.0})
        return scored.withColumn("sentiment", label_by(F.col("score"), fixed.SENTIMENT_CUT)).withColumnRenamed(
            "score", "sentiment_score"
        )
    if method == "polarity":
        scores = polarity(df, lexicon, order_key).select(order_key, F.col("polarity").alias("sentiment_score"))
        scored = attach(df, scores, order_key, {"sentiment_score": 0.0})
        s = F.col("sentiment_score")
        return scored.withColumn(
            "sentiment", F.when(s > 0, "positive").when(s < 0, "negative").otherwise("neutral")
        )
    if method == "model":
        from murmuro.operators.classify import predict

        predicted = predict(model, df)
        return predicted.withColumn("sentiment", F.lower("prediction_label")).withColumnRenamed(
            "prediction_score", "sentiment_score"
        ).drop("prediction_label")
    raise ValueError("method must be 'rules', 'polarity' or 'model'")


# Emotions


def emotion_totals(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Hits per emotion over the whole corpus, all eight emotions in fixed order.

    Words are counted before the lookup, so the lexicon meets each distinct word once.
    """
    counted = (
        unnest(df, tokens.words(F.col("text")), "word").groupBy("word").agg(n_rows("n"))
    )
    hits = lookup_join(counted, lexicon, "word").groupBy("emotion").agg(F.sum("n").alias("count"))
    spine = fixed_table(df.sparkSession, list(enumerate(fixed.EMOTIONS)), "place int, emotion string")
    return (
        spine.join(hits, "emotion", "left")
        .orderBy("place")
        .select("emotion", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
    )


def top_emotion_comments(
    df: DataFrame, lexicon: DataFrame, emotion: str, n: int = 10, order_key: str = "doc_id"
) -> DataFrame:
    """The `n` comments with the largest share of this emotion among their emotion words."""
    rows = unnest(df, tokens.words(F.col("text")), "word", order_key)
    hits = lookup_join(rows, lexicon, "word")
    share = F.round(F.avg((F.col("emotion") == emotion).cast("double")), 9)
    scored = hits.groupBy(order_key).agg(share.alias("share")).where("share > 0")
    scored = scored.select(order_key, F.round("share", 3).alias("intensity"))
    best = top(scored, n, F.desc("intensity"), F.asc(order_key))
    return df.select(order_key, "text").join(F.broadcast(best), order_key)

"""Word, n-gram, collocation and distinctive-term statistics."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import text, tokens
from murmuro.operators.order import prefix_sum
from murmuro.runtime import is_small, lookup_join, n_rows, scalar, top, unnest, written


def token_arrays(df: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(order key, tokens): the clean tokens of each comment in order."""
    return df.select(order_key, tokens.clean_tokens(F.col("text")).alias("tokens"))


def token_rows(df: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(order key, pos, token), positions dense within the comment."""
    return unnest(token_arrays(df, order_key), "tokens", "token", order_key, pos="pos")


def without_stop_words(rows: DataFrame, *lists: DataFrame) -> DataFrame:
    """Token rows not in the union of the given stop-word tables (column `word`)."""
    stop = reduce(DataFrame.unionByName, lists).distinct().withColumnRenamed("word", "token")
    return lookup_join(rows, stop, "token", "left_anti")


def _counted(arrays: DataFrame, n: int, name: str, among: DataFrame | None = None) -> DataFrame:
    """(name, n): n-grams inside the token lists, counted per batch, so that one may come several times.

    With `among`, a table that may travel, only n-grams of its tokens.
    """
    words = None if among is None else arrays.sparkSession.sparkContext.broadcast(among.select("token").toArrow()["token"].combine_chunks())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, counts in tokens.gram_counts(batch.column(0), n, words and words.value):
                yield pa.RecordBatch.from_arrays([grams, pa.array(counts, pa.int64())], names=[name, "n"])

    return arrays.select("tokens").mapInArrow(counted, f"{name} string, n bigint")


def count_words(arrays: DataFrame) -> DataFrame:
    return _counted(arrays, 1, "token").groupBy("token").agg(F.sum("n").alias("count"))


def attested_lemmas(vocabulary: DataFrame) -> DataFrame:
    """(word, lemma): the shortest noun-ending detachment that is itself a word of the vocabulary."""
    words = vocabulary.select("token").distinct()
    stems = [
        F.when(
            F.col("token").endswith(ending),
            F.concat(F.expr(f"left(token, length(token) - {len(ending)})"), F.lit(replacement)),
        )
        for ending, replacement in fixed.DETACHMENTS
    ]
    candidates = unnest(words, F.array_compact(F.array(*stems)), "token", F.col("token").alias("word"))
    attested = candidates.join(words, "token").where(F.length("token") < F.length("word"))
    return attested.groupBy("word").agg(F.min(F.struct(F.length("token").alias("n"), "token"))["token"].alias("lemma"))


def lemmatised(counts: DataFrame, lemmas: DataFrame, n: int = 1, name: str = "token") -> DataFrame:
    """Counts of lemmas instead of words.

    Lemmas are looked up after counting: each distinct word or n-gram meets the lemma
    table once, however often it occurs in the corpus.
    """
    parts = F.split(name, " ")
    split = counts.select("count", *[parts[i].alias(f"w{i}") for i in range(n)])
    for i in range(n):
        table = lemmas.select(F.col("word").alias(f"w{i}"), F.col("lemma").alias(f"l{i}"))
        split = lookup_join(split, table, f"w{i}", "left").withColumn(f"w{i}", F.coalesce(f"l{i}", f"w{i}"))
    joined = F.concat_ws(" ", *[f"w{i}" for i in range(n)]).alias(name)
    return split.groupBy(joined).agg(F.sum("count").alias("count"))


def lemma_arrays(df: DataFrame, lemmas: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(order key, tokens): the tokens of each comment in order, each as its lemma where it has one.

    A lemma table counted small goes to every executor and is looked up inside the row; a larger one is joined.
    """
    arrays = token_arrays(df, order_key)
    table = lemmas.select("word", "lemma")
    if is_small(table):
        known = df.sparkSession.sparkContext.broadcast({r.word: r.lemma for r in table.collect()})

        @F.arrow_udf("array<string>")
        def looked_up(lists: pa.Array) -> pa.Array:
            names = known.value
            return pa.array([None if t is None else [names.get(w, w) for w in t] for t in lists.to_pylist()], pa.list_(pa.string()))

        return arrays.select(order_key, looked_up("tokens").alias("tokens"))
    rows = unnest(arrays, "tokens", "word", order_key, pos="pos")
    rows = lookup_join(rows, table, "word", "left", spread=[order_key]).withColumn("token", F.coalesce("lemma", "word"))
    found = rows.groupBy(order_key).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("x"))
    found = found.select(order_key, F.col("x.token").alias("_lemmas"))
    joined = arrays.join(found.hint("merge"), order_key, "left")
    return joined.select(order_key, F.coalesce("_lemmas", "tokens").alias("tokens"))


def word_frequencies(df: DataFrame, n: int = 30, lemmas: DataFrame | None = None) -> DataFrame:
    counts = count_words(token_arrays(df))
    if lemmas is not None:
        counts = lemmatised(counts, lemmas)
    return top(counts, n, F.desc("count"), F.asc("token"))


def cloud_weights(df: DataFrame, n: int = 120, lemmas: DataFrame | None = None) -> DataFrame:
    """The `n` most frequent words with their size relative to the first."""
    best = word_frequencies(df, n, lemmas)
    return best.withColumn("weight", F.col("count") / F.max("count").over(Window.partitionBy(F.lit(0))))


def spanning_ngrams(arrays: DataFrame, n: int, order_key: str = "doc_id") -> DataFrame:
    """N-grams that run from one comment into the next ones, as if all tokens were one list.

    Only tokens within n-1 of a comment's edge can take part. They get corpus positions
    from a prefix sum over token counts and meet by position, which is unique.
    """
    edge = n - 1
    placed = F.transform("tokens", lambda t, j: F.struct(j.alias("j"), t.alias("token")))
    size = F.size("tokens")
    # A comment's edges are cut out in the row: nothing else of it is exploded or joined.
    last = F.greatest(size - edge, F.least(F.lit(edge), size))
    ends = F.concat(F.slice(placed, 1, edge), F.slice(placed, last + 1, F.lit(edge)))
    sized = arrays.where(size > 0).select(order_key, size.cast("bigint").alias("size"), ends.alias("ends"))
    starts = prefix_sum(sized.select(order_key, "size"), order_key, "size", "start").drop("size")
    edges = unnest(sized.select(order_key, "ends").join(starts, order_key), "ends", "x", order_key, "start")
    edges = edges.select(order_key, (F.col("start") + F.col("x.j")).alias("at"), "x.token")
    run = edges.select(F.col("at"), F.col(order_key).alias("first_doc"), F.col("token").alias("gram"))
    for j in range(1, n):
        step = edges.select((F.col("at") - j).alias("at"), F.col(order_key).alias("last_doc"), F.col("token").alias("next"))
        run = run.drop("last_doc").join(step, "at").withColumn("gram", F.concat_ws(" ", "gram", "next")).drop("next")
    return run.where(F.col("first_doc") != F.col("last_doc")).select("gram")


def count_ngrams(
    arrays: DataFrame, n: int, span: bool = False, order_key: str = "doc_id", among: DataFrame | None = None
) -> DataFrame:
    """Counts of adjacent n-grams, within comments or over the whole token list; inside comments on request only among some tokens."""
    grams = _counted(arrays, n, "gram", among)
    if span:
        grams = grams.unionByName(spanning_ngrams(arrays, n, order_key).withColumn("n", F.lit(1).cast("bigint")))
    return grams.groupBy("gram").agg(F.sum("n").alias("count"))


# One comment in so many gives the count that a frequent n-gram has at least.
PART = 16


def top_ngrams(
    df: DataFrame, n: int = 2, limit: int = 20, span: bool = False, lemmas: DataFrame | None = None, order_key: str = "doc_id"
) -> DataFrame:
    """The `limit` most frequent n-grams.

    An n-gram is no more frequent than any of its words, and the last of the most frequent ones has at least the count
    that it has in some of the comments. So n-grams with a rarer word are not counted, where the others may travel.
    """
    arrays = written(token_arrays(df, order_key), "tokens")

    def counted(part: DataFrame, span: bool = False, among: DataFrame | None = None) -> DataFrame:
        counts = count_ngrams(part, n, span, order_key, among)
        return counts if lemmas is None else lemmatised(counts, lemmas, n, "gram")

    first = top(counted(arrays.where(F.pmod(F.xxhash64(order_key), F.lit(PART)) == 0)), limit, F.desc("count"), F.asc("gram"))
    reached = [r["count"] for r in first.select("count").collect()]
    among = None
    if len(reached) == limit:
        words = count_words(arrays)
        if lemmas is not None:
            words = lookup_join(words, lemmas.select(F.col("word").alias("token"), "lemma"), "token", "left")
            kin = Window.partitionBy(F.coalesce("lemma", "token"))
            words = words.withColumn("count", F.sum("count").over(kin))
        words = written(words.where(F.col("count") >= min(reached)).select("token"), "frequent-words")
        among = words if is_small(words) else None
    return top(counted(arrays, span, among), limit, F.desc("count"), F.asc("gram"))


def collocations(
    df: DataFrame, n: int = 2, limit: int = 20, min_count: int = 3, span: bool = False, lemmas: DataFrame | None = None
) -> DataFrame:
    """The bigrams or trigrams of highest pointwise mutual information, with their counts.

    Word counts are written once: they give the total, the size check and the lookups. With
    lemmas, words and n-grams are counted first and their lemmas looked up afterwards.
    """
    if n not in (2, 3):
        raise ValueError("n must be 2 or 3")
    arrays = written(token_arrays(df), "tokens")
    words, grams = count_words(arrays), count_ngrams(arrays, n, span)
    if lemmas is not None:
        words, grams = lemmatised(words, lemmas), lemmatised(grams, lemmas, n, "gram")
    words = written(words, "words")
    total = scalar(words.agg(F.sum("count")))
    rows = grams.where(F.col("count") >= min_count)
    parts = F.split("gram", " ")
    rows = rows.select("gram", "count", *[parts[i].alias(f"w{i}") for i in range(n)])
    for i in range(n):
        table = words.select(F.col("token").alias(f"w{i}"), F.col("count").alias(f"c{i}"), F.col("count").alias("rows"))
        rows = lookup_join(rows, table, f"w{i}", weight="rows")
    singles = reduce(Column.__mul__, [F.col(f"c{i}").cast("double") for i in range(n)])
    expected = F.pow(total.cast("double"), F.lit(n - 1))
    scored = rows.withColumn("pmi", F.round(F.log2(F.col("count") * expected) - F.log2(singles), 9))
    return top(scored, limit, F.desc("pmi"), F.asc("gram")).select("gram", F.col("count").alias("freq"), "pmi")


def emoji_counts(df: DataFrame, n: int = 20, column: str = "text_raw") -> DataFrame:
    """Most frequent emoji of the original text (cleaning removes them)."""
    found = unnest(df, text.emojis(F.col(column)), "emoji")
    return top(found.groupBy("emoji").agg(n_rows()), n, F.desc("count"), F.asc("emoji"))


def uni_and_bigrams(toks: Column) -> Column:
    return F.concat(toks, tokens.ngrams(toks, 2))


def distinctive_terms(df: DataFrame, label: str = "sentiment", n: int = 12, max_terms: int = 5000) -> DataFrame:
    """Top TF-IDF terms of each label, all its comments taken as one document.

    The `max_terms` most frequent terms make the vocabulary; nothing is returned for
    fewer than two labels.
    """
    arrays = df.dropna(subset=["text", label]).select(label, tokens.feature_tokens(F.col("text")).alias("toks"))
    per_label = written(
        unnest(arrays, uni_and_bigrams(F.col("toks")), "term", label).groupBy(label, "term").agg(n_rows()),
        "terms",
    )
    frequent = top(per_label.groupBy("term").agg(F.sum("count").alias("all")), max_terms, F.desc("all"), F.asc("term"))
    groups = scalar(per_label.agg(F.count_distinct(label)))
    kept = per_label.join(F.broadcast(frequent.select("term")), "term", "left_semi")
    idf = kept.groupBy("term").agg((F.log((1 + groups) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    # At most max_terms rows per label from here on.
    weighted = kept.join(F.broadcast(idf), "term").withColumn("weight", F.col("count") * F.col("idf"))
    within = Window.partitionBy(label)
    scored = weighted.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(within))).withColumn(
        "score", F.round(F.col("weight") / F.col("norm"), 9)
    )
    ranked = scored.withColumn("rank", F.row_number().over(within.orderBy(F.desc("score"), F.asc("term"))))
    return ranked.where((F.col("rank") <= n) & (groups >= 2)).select(label, "rank", "term", "score")

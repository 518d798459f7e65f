"""Counts, shares and histograms of the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuro.functions import text
from murmuro.runtime import lookup_join, n_rows, top, unnest, written


def counts(df: DataFrame, *names: str) -> DataFrame:
    """Rows per combination of the named columns, missing values left out."""
    return df.dropna(subset=list(names)).groupBy(*names).agg(n_rows())


def top_counts(df: DataFrame, name: str, n: int) -> DataFrame:
    """The `n` most frequent values, ties by value."""
    return top(counts(df, name), n, F.desc("count"), F.asc(name))


def percentages(df: DataFrame, name: str = "sentiment") -> DataFrame:
    """Percent of the non-missing rows per value, one decimal, halves to even.

    The window sees the counted values only, so the table itself is read once.
    """
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts(df, name).select(name, F.bround(F.col("count") / total * 100, 1).alias("percent"))


def mood(df: DataFrame) -> DataFrame:
    """Positive and negative percent of all rows (missing counts as neither) and the mood in words."""
    share = lambda label: F.avg(F.coalesce((F.col("sentiment") == label).cast("double"), F.lit(0.0))) * 100
    shares = df.agg(share("positive").alias("positive"), share("negative").alias("negative"))
    words = (
        F.when(F.col("positive") > 60, "overwhelmingly positive")
        .when(F.col("positive") > F.col("negative"), "mostly positive")
        .when(F.col("negative") > F.col("positive"), "mostly negative")
        .otherwise("mixed")
    )
    return shares.select("positive", "negative", words.alias("mood"))


def totals(df: DataFrame) -> DataFrame:
    """One row: number of comments, likes, words per comment, question share, first and last date."""
    return df.agg(
        n_rows("comments"),
        F.coalesce(F.sum("likes"), F.lit(0)).alias("likes"),
        F.coalesce(F.avg(text.word_count(F.col("text"))), F.lit(0.0)).alias("avg_words"),
        F.coalesce(F.avg(text.is_question(F.col("text")).cast("double")), F.lit(0.0)).alias("question_share"),
        F.min("published_at").alias("first_date"),
        F.max("published_at").alias("last_date"),
    )


def question_share(df: DataFrame) -> DataFrame:
    """Share of comments with a question mark, 0 for an empty table."""
    asked = text.is_question(F.col("text")).cast("double")
    return df.agg(n_rows("comments"), F.coalesce(F.avg(asked), F.lit(0.0)).alias("question_share"))


def monthly(df: DataFrame) -> DataFrame:
    """Comments per month and sentiment."""
    dated = df.dropna(subset=["published_at"]).withColumn("month", text.month(F.col("published_at")))
    return counts(dated, "month", "sentiment")


def length_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    """Comments per equal-width bin of their word count; empty bins are left out.

    Comments are counted per length first; bounds and bins are then found among the
    distinct lengths, so the texts are read once.
    """
    lengths = df.select(text.word_count(F.col("text")).cast("double").alias("words")).groupBy("words").agg(n_rows("n"))
    all_lengths = Window.partitionBy(F.lit(0))
    bounded = lengths.withColumns({"lo": F.min("words").over(all_lengths), "hi": F.max("words").over(all_lengths)})
    width = F.greatest((F.col("hi") - F.col("lo")) / bins, F.lit(1e-9))
    slot = F.least(F.floor((F.col("words") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    placed = bounded.select("n", slot.alias("bin"), (F.col("lo") + slot * width).alias("bin_start"))
    return placed.groupBy("bin", "bin_start").agg(F.sum("n").alias("count"))


def readability(df: DataFrame) -> DataFrame:
    """Corpus reading ease and grade level from word, sentence and syllable totals."""
    t = F.col("text")
    sums = df.where(t.isNotNull()).agg(
        F.sum(text.word_count(t)).cast("bigint").alias("words"),
        F.sum(text.sentence_count(t)).cast("bigint").alias("sentences"),
        F.sum(text.syllable_count(t)).cast("bigint").alias("syllables"),
    )
    per_sentence = F.col("words") / F.greatest("sentences", F.lit(1))
    per_word = F.col("syllables") / F.greatest("words", F.lit(1))
    return sums.select(
        "words",
        "sentences",
        "syllables",
        (F.lit(206.835) - per_sentence * 1.015 - per_word * 84.6).alias("reading_ease"),
        (per_sentence * 0.39 + per_word * 11.8 - 15.59).alias("grade_level"),
    )


def without_outliers(df: DataFrame) -> DataFrame:
    """Rows that belong to a topic."""
    return df.where(F.col("topic") != -1)


def top_topics(df: DataFrame, n: int = 8) -> DataFrame:
    return top_counts(without_outliers(df), "topic", n)


def topic_sentiment(df: DataFrame, n: int = 8) -> DataFrame:
    """Topic by sentiment counts for the `n` largest topics (so at most `n` rows are sent around)."""
    largest = F.broadcast(top_topics(df, n).select("topic"))
    return counts(without_outliers(df).join(largest, "topic", "left_semi"), "topic", "sentiment")


def strongest(grouped: DataFrame, *names: str) -> DataFrame:
    """The leading row of a count table, ties by name."""
    return top(grouped, 1, F.desc("count"), *[F.asc(c) for c in names])


def list_counts(df: DataFrame, name: str, n: int | None = None) -> DataFrame:
    """Element counts of a list column; the top `n`, or all."""
    per_value = unnest(df, name, name).groupBy(name).agg(n_rows())
    return per_value if n is None else top(per_value, n, F.desc("count"), F.asc(name))


def topic_labels(df: DataFrame, words: int = 5) -> DataFrame:
    """Each topic's most frequent keywords, joined; `topic <id>` where it has none.

    Counts are taken first, so the window ranks distinct keywords, and a rank limit of 5
    cuts each task's rows before they are shuffled. The keywords are written once, as they
    are read for the topics and for their words.
    """
    inside = written(without_outliers(df).select("topic", "keywords"), "topic-keywords")
    keyword_counts = (
        unnest(inside, "keywords", "word", "topic")
        .groupBy("topic", "word")
        .agg(n_rows())
    )
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("count"), F.asc("word")))
    best = keyword_counts.withColumn("rank", rank).where(F.col("rank") <= words)
    names = best.groupBy("topic").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]), ", ").alias(
            "name"
        )
    )
    fallback = F.concat(F.lit("topic "), F.col("topic").cast("string"))
    return inside.select("topic").distinct().join(names, "topic", "left").select(
        "topic", F.coalesce("name", fallback).alias("label")
    )


def relabel(grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach topic labels to a topic count table, empty text when there is none."""
    named = lookup_join(grouped, written(labels.withColumnRenamed("label", "keywords"), "labels"), "topic", "left")
    return named.withColumn("keywords", F.coalesce("keywords", F.lit("")))


def distinct_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count_distinct(name).alias("values"))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).dropna().distinct().orderBy(name)


def subjective_share(df: DataFrame, cut: float = 0.5) -> DataFrame:
    """Percent of comments that are more opinion than fact."""
    share = F.coalesce(F.avg((F.col("subjectivity") > cut).cast("double")), F.lit(0.0))
    return df.agg((share * 100).alias("subjective_percent"))


def first_joined(df: DataFrame, n: int, order_key: str = "doc_id") -> DataFrame:
    """The first `n` comments (a small, stated number) as one document, one per line."""
    chosen = top(df.select(order_key, "text"), n, F.asc(order_key))
    lines = F.transform(F.sort_array(F.collect_list(F.struct(order_key, "text"))), lambda s: s["text"])
    return chosen.agg(F.array_join(lines, "\n").alias("text"))

"""Report rows: the data part of the insight and report answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import text
from murmuro.operators import overview, retrieval


def _rows(df: DataFrame, section: str, line: Column, *order: Column) -> DataFrame:
    """Lines of one section numbered from 1 (sections hold at most a few dozen rows)."""
    number = F.row_number().over(Window.partitionBy(F.lit(section)).orderBy(*order))
    return df.select(F.lit(section).alias("section"), number.alias("line_no"), line.alias("line"))


def sentiment_insight(df: DataFrame) -> DataFrame:
    """Share of each sentiment, largest first."""
    shares = overview.percentages(df, "sentiment")
    line = F.concat("sentiment", F.lit(": "), F.format_number("percent", 1), F.lit("%"))
    return _rows(shares, "sentiment", line, F.desc("percent"), F.asc("sentiment"))


def negative_examples(
    queries: DataFrame, index: DataFrame, docs: DataFrame, k: int = 5, sentiment: str = "negative"
) -> DataFrame:
    """The nearest negative comments per aspect query."""
    hits = retrieval.filtered(queries, index, {"sentiment": sentiment}, k)
    return retrieval.with_columns_of(hits, docs, "text")


def topic_insight(df: DataFrame, n: int = 8) -> DataFrame:
    """Largest topics; a message row if the table has no topic column."""
    if "topic" not in df.columns:
        row = df.sparkSession.range(1)
        return _rows(row, "topics", F.lit("Topic modeling has not been run yet."), F.col("id"))
    line = F.format_string("topic %d (%d)", F.col("topic"), F.col("count"))
    return _rows(overview.top_topics(df, n), "topics", line, F.desc("count"), F.asc("topic"))


def list_insight(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    """Most frequent elements of a list column; nothing if the table lacks it."""
    if name not in df.columns:
        return df.sparkSession.createDataFrame([], "section string, line_no int, line string")
    return _rows(overview.list_counts(df, name, n), name, F.col(name), F.desc("count"), F.asc(name))


def full_report(df: DataFrame, topics: int = 6) -> DataFrame:
    """Sentiment, topics, entities, keywords, in that order, as (section_no, section, line_no, line)."""
    parts = [
        sentiment_insight(df),
        topic_insight(df, topics),
        list_insight(df, "entities"),
        list_insight(df, "keywords"),
    ]
    numbered = [p.select(F.lit(i + 1).alias("section_no"), "section", "line_no", "line") for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered).orderBy("section_no", "line_no")


def summary_context(queries: DataFrame, index: DataFrame, docs: DataFrame, k: int = 12) -> DataFrame:
    """The top `k` comments per topic query as one context text."""
    hits = retrieval.semantic(queries, index, k)
    return retrieval.context_blocks(retrieval.with_columns_of(hits, docs, "text", "sentiment", "likes"))


def routed(queries: DataFrame, categories: list[str] | None = None, default: str = "qa") -> DataFrame:
    """Add category and specialist to a table of label texts (column `text`)."""
    category = text.first_category(F.col("text"), categories or fixed.QUERY_CATEGORIES, default)
    specialist = F.lit(fixed.SPECIALISTS["qa"])
    for name, agent in fixed.SPECIALISTS.items():
        specialist = F.when(F.col("category") == name, F.lit(agent)).otherwise(specialist)
    return queries.withColumn("category", category).withColumn("specialist", specialist)

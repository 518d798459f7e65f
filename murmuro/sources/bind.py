"""The comment schema, and the driver tables bound to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuro.runtime import lookup_join

RAW_COMMENTS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("likes", T.LongType()),
        T.StructField("published_at", T.StringType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table stored in fewer pieces than there are cores; larger tables are left as they are.

    Done by the row key, so later work per row id reuses the partitioning.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts alone: no join, for analytics that need neither likes nor dates.

    `doc_id` is the order key everywhere: files have no order of their own in Spark.
    """
    stored = table(spark, folder, "documents").select("doc_id", F.col("source").alias("video_id"), "text", "lang")
    return spread(stored, "doc_id")


def comments(spark: SparkSession, folder: str, author: bool = False) -> DataFrame:
    """Texts with likes and date from the order of the same key, and on request the author."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("likes"),
        F.col("o_orderdate").alias("published_at"),
        "o_custkey",
    )
    joined = documents(spark, folder).join(orders, "doc_id")
    if author:
        customers = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("author")
        )
        joined = lookup_join(joined, customers, "o_custkey", "left", spread=["doc_id"])
    return joined.drop("o_custkey")


def topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topic assignments (doc_id, topic) given with the stored vectors."""
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic"))


def with_topics(df: DataFrame, assignments: DataFrame) -> DataFrame:
    """Attach topics by id; rows without one get the outlier topic -1."""
    joined = df.join(assignments, "doc_id", "left")
    return joined.withColumn("topic", F.coalesce("topic", F.lit(-1)))


def column_or(df: DataFrame, name: str, default: Column, kind: str) -> Column:
    """The column if the frame has it, else a default: optional columns degrade instead of failing."""
    return F.col(name).cast(kind) if name in df.columns else default.cast(kind)


def pick(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])

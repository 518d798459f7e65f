"""File sources and sinks of the comment tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuro import fixed_values as fixed
from murmuro.functions import text
from murmuro.operators.order import prefix_sum
from murmuro.sources import csv_ranges
from murmuro.sources.bind import RAW_COMMENTS

COLLECTOR_PAGE = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "snippet",
                            T.StructType(
                                [
                                    T.StructField(
                                        "topLevelComment",
                                        T.StructType(
                                            [
                                                T.StructField(
                                                    "snippet",
                                                    T.StructType(
                                                        [
                                                            T.StructField("authorDisplayName", T.StringType()),
                                                            T.StructField("textDisplay", T.StringType()),
                                                            T.StructField("likeCount", T.LongType()),
                                                            T.StructField("publishedAt", T.StringType()),
                                                        ]
                                                    ),
                                                )
                                            ]
                                        ),
                                    )
                                ]
                            ),
                        )
                    ]
                )
            ),
        ),
        T.StructField("nextPageToken", T.StringType()),
    ]
)


def _file_names(spark: SparkSession, path: str, n: int) -> list[str] | None:
    """Up to `n` data files at or under a path, None when there is no such path."""
    try:
        return [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").limit(n).collect()]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds data files, on whatever file system it names."""
    return bool(_file_names(spark, path, 1))


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a path is a single file, or a folder whose write came to its end (it has a `_SUCCESS`)."""
    if _file_names(spark, f"{path}/_SUCCESS", 1) is not None:
        return True
    found = _file_names(spark, path, 2) or []
    return len(found) == 1 and found[0].endswith("/" + path.rstrip("/").rsplit("/", 1)[-1])


def read_comments_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_COMMENTS) -> DataFrame:
    """Comment CSV with quoted line breaks, one file read by many tasks; the usual missing-value spellings become NULL."""
    raw = csv_ranges.read_csv(spark, path, schema)
    missing = [
        F.when(~F.col(f.name).isin(fixed.MISSING_CELLS), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in schema
    ]
    return raw.select(missing)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink; list columns are written as JSON text because CSV has no lists."""
    flat = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType)) else F.col(f.name)
        for f in df.schema
    ]
    df.select(flat).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_enriched(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def load_comments(spark: SparkSession, enriched: str, clean_csv: str, empty: T.StructType = RAW_COMMENTS) -> DataFrame:
    """The enriched table if it is there, else the clean CSV, else an empty frame; dates parsed."""
    if complete(spark, enriched):
        df = spark.read.parquet(enriched)
    elif exists(spark, clean_csv):
        df = read_comments_csv(spark, clean_csv)
    else:
        return spark.createDataFrame([], empty)
    if "published_at" in df.columns and dict(df.dtypes)["published_at"] == "string":
        df = df.withColumn("published_at", text.parse_time(F.col("published_at")))
    return df


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Collector pages to one row per comment, numbered inside the page."""
    item = F.col("item.snippet.topLevelComment.snippet")
    return pages.select("video_id", "page_no", F.posexplode("items").alias("item_no", "item")).select(
        "video_id",
        "page_no",
        "item_no",
        item.getField("authorDisplayName").alias("author"),
        item.getField("textDisplay").alias("text"),
        item.getField("likeCount").alias("likes"),
        item.getField("publishedAt").alias("published_at"),
    )


def collect_pages(pages: DataFrame, target: int, video_order: list[str]) -> DataFrame:
    """Collected comments: whole pages in order until `target` rows are reached, then unique texts.

    The running total is taken over one narrow row per page; comments themselves only meet
    the list of kept pages.
    """
    video_no = F.array_position(F.array(*[F.lit(v) for v in video_order]), F.col("video_id"))
    sizes = pages.where(F.col("video_id").isin(video_order)).select(
        "video_id",
        "page_no",
        (video_no * F.lit(1 << 32) + F.col("page_no")).alias("page_key"),
        F.size("items").cast("bigint").alias("rows"),
    )
    kept = prefix_sum(sizes, "page_key", "rows", "before").where(F.col("before") < target)
    kept = kept.select("video_id", "page_no", "page_key")
    rows = flatten_pages(pages).join(kept, ["video_id", "page_no"])
    first = F.struct("page_key", "item_no", "video_id", "author", "likes", "published_at")
    return (
        rows.groupBy("text")
        .agg(F.min(first).alias("first"))
        .select("first.video_id", "first.author", "text", "first.likes", "first.published_at")
    )


def write_index(docs: DataFrame, vectors: DataFrame, path: str, reset: bool = True) -> None:
    """Join documents with their vectors by id and write the index table."""
    docs.join(vectors, "doc_id").write.mode("overwrite" if reset else "append").parquet(path)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str, run_name: str, params: dict[str, str]) -> None:
    """Append one run's metrics (key, value) with its parameters."""
    pairs = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    bag = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    metrics.select(
        F.lit(run_name).alias("run_name"), "key", F.col("value").cast("double").alias("value"), bag.alias("params")
    ).write.mode("append").parquet(path)


def build_stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False) -> DataFrame:
    """Build a stage's table unless it is already there in full; `rebuild` forces it."""
    if rebuild or not complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

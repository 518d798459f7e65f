"""Positions over a whole data set without a single-task window.

Rows are cut into buckets by value ranges of a unique order key. The buckets are a
pure function of the key, so a lost task recomputes exactly the same rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """Add `_bucket`: evenly filled value ranges of the order key, about one per shuffle partition."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    cuts = df.approxQuantile(key, [i / n for i in range(1, n)], 1 / (4 * n))
    # An empty table has no quantiles, and one cut at least is asked for.
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket")
    return cut.transform(df.withColumn("_key", F.col(key).cast("double"))).drop("_key")


def prefix_sum(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows before this one in key order.

    Sums per bucket, a running sum over the few bucket totals, and a window inside each
    bucket. `df` is read twice: pass a written table if it is costly to compute.
    """
    parts = bucketed(df, key)
    totals = parts.groupBy("_bucket").agg(F.sum(value).alias("_total"))
    # One row per bucket, so this window sees at most as many rows as there are shuffle partitions.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("bigint"))
        .drop("_bucket", "_start")
    )


def row_numbers(df: DataFrame, key: str, name: str = "row_no") -> DataFrame:
    """Add 0, 1, 2, … in key order."""
    return prefix_sum(df.withColumn("_one", F.lit(1).cast("bigint")), key, "_one", name).drop("_one")

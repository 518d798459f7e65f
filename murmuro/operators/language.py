"""Language identification by character trigrams (naive Bayes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro.runtime import lookup_join, n_rows, scalar, unnest, written


def trigrams(c: Column) -> Column:
    """Overlapping letter trigrams within words."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?=(\p{L}{3}))"), 1)


def train_profiles(df: DataFrame, label: str = "lang") -> tuple[DataFrame, list[str]]:
    """One row per trigram with its count and its add-one log probability in every language, and the names.

    The counts are written once; there is one name per language label.
    """
    rows = unnest(df.dropna(subset=[label]), trigrams(F.col("text")), "gram", label)
    counted = written(rows.groupBy(label, "gram").agg(n_rows("n")), "trigrams")
    totals = counted.groupBy(label).agg(F.sum("n").alias("total")).orderBy(label).collect()
    distinct = scalar(counted.agg(F.count_distinct("gram")))
    columns = []
    for i, row in enumerate(totals):
        n = F.coalesce(F.sum(F.when(F.col(label) == row[label], F.col("n"))), F.lit(0))
        columns.append(F.log((n + 1) / (F.lit(row["total"]) + distinct)).alias(f"logp{i}"))
    return written(counted.groupBy("gram").agg(*columns, F.sum("n").alias("rows")), "profiles"), [r[label] for r in totals]


def detect(df: DataFrame, profiles: DataFrame, names: list[str], order_key: str = "doc_id") -> DataFrame:
    """(order key, language): the most probable language, `unknown` without any known trigram."""
    rows = unnest(df, trigrams(F.col("text")), "gram", order_key)
    scored = lookup_join(rows, profiles, "gram", spread=[order_key], weight="rows").groupBy(order_key).agg(
        *[F.round(F.sum(f"logp{i}"), 6).alias(f"s{i}") for i in range(len(names))]
    )
    best = F.greatest(*[F.col(f"s{i}") for i in range(len(names))]) if len(names) > 1 else F.col("s0")
    language = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        language = F.when(F.col(f"s{i}") == best, F.lit(names[i])).otherwise(language)
    found = scored.select(order_key, language.alias("language"))
    joined = df.select(order_key).join(found, order_key, "left")
    return joined.withColumn("language", F.coalesce("language", F.lit("unknown")))


def distribution(detected: DataFrame) -> DataFrame:
    return detected.groupBy("language").agg(n_rows()).orderBy(F.desc("count"), F.asc("language"))

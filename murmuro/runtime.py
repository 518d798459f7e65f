"""Session, shared-storage and join helpers used by every operator."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is sent to every executor only after a count has shown it stays at or under this many rows.
BROADCAST_ROWS = 200_000
# Copies of a lookup table (and slices of each hot key) when it is too large to send everywhere.
SALTS = 32

_LOCAL_FOLDERS: dict[str, str] = {}
# Lists that the folders of written tables are noted in, see `recorded`.
_RECORDS: list[list[str]] = []


def session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("murmuro")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="murmuro-")
    return _LOCAL_FOLDERS[app]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and later readers still
    get column pruning, filter pushdown and file statistics.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/{label}"
    for record in _RECORDS:
        record.append(path)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Spark's setting by which a finished write removes its shuffle files.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files when they are done, not when the driver next collects garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Notes the folder of every table that is `written` inside the block, so that it can be removed later."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not paths]


def remove_folders(spark: SparkSession, paths: list[str], reader: DataFrame | None = None) -> list[str]:
    """Delete folders of written tables, but for those that `reader` still reads; these are returned."""
    read = reader.inputFiles() if reader is not None else []
    kept = []
    for path in paths:
        # The folder above the label has a name of its own.
        if any(path.split("/")[-2] in file for file in read):
            kept.append(path)
            continue
        system, folder = _file_system(spark, path)
        system.delete(folder, True)
    return kept


def exists_folder(spark: SparkSession, path: str) -> bool:
    """Is there such a folder, on whatever file system the path names?"""
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def _file_system(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def fixed_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small table of constants, e.g. `fixed_table(spark, [("the",)], "word string")`."""
    schema = _arrow_schema(columns)
    arrays = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.table(arrays, schema=schema))


def _arrow_schema(columns: str) -> pa.Schema:
    types = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], types[c.split()[1]]) for c in columns.split(",")])


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Count at most `rows + 1` rows to learn whether `df` is safe to send to every executor."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread: list[str | Column] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Join many rows to a table that has one row (or few) per key.

    A table counted small goes to every executor, so the big side is not shuffled at all.
    A larger one is joined on (key, salt), see `salted_join`. No row is dropped either way.
    Pass a written table if it is costly to compute, because it is counted first.
    """
    if is_small(table):
        return rows.join(F.broadcast(table.drop(weight) if weight else table), on, how)
    return salted_join(rows, table, on, how, spread, weight)


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread: list[str | Column] | None = None,
    weight: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join on (key, salt): a key that holds a third of all rows is shared by `salts` tasks.

    `weight` names a column of the table with about how many rows each key has. Then only
    hot keys, those with more than a tenth of a task's fair share, are repeated and salted.
    There are at most ten times as many of them as shuffle partitions, so their list may
    travel. Without weights every key is repeated.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spread = spread or [c for c in rows.columns if c not in keys] or keys
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if weight is None:
        left = rows.withColumn("_salt", salt)
        right = table.withColumn("_salt", F.explode(every))
    else:
        share = 10 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = F.col(weight) * share > scalar(table.agg(F.sum(weight)))
        hot_keys = table.where(hot).select(*keys, F.lit(True).alias("_hot"))
        left = rows.join(F.broadcast(hot_keys), keys, "left")
        left = left.withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
        right = table.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0))))).drop(weight)
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def scalar(df: DataFrame) -> Column:
    """A one-row, one-column frame as a column (an uncorrelated scalar subquery)."""
    return df.scalar()


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first `n` rows in the given order."""
    return df.orderBy(*order).limit(n)


def n_rows(name: str = "count") -> Column:
    """Number of rows, as an aggregate of that name."""
    return F.count(F.lit(1)).alias(name)


def unnest(df: DataFrame, array: Column | str, name: str, *keep: str | Column, pos: str | None = None) -> DataFrame:
    """One row per element of a computed array, with the kept columns and on request the position.

    The array is computed in a step of its own and exploded with the outer variant. The plain
    one adds a filter on the array's size below itself, which would compute the array twice.
    """
    array = F.col(array) if isinstance(array, str) else array
    place = pos or "_pos"
    out = df.select(*keep, array.alias("_items"))
    kept = [c for c in out.columns if c != "_items"]
    out = out.select(*kept, F.posexplode_outer("_items").alias(place, name)).where(F.col(place).isNotNull())
    return out if pos else out.drop(place)

"""Incremental ingest: new comment files to a table of clean, unique comments."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from murmuro import fixed_values as fixed
from murmuro.functions import text

# Keeps the state of each key by itself on disk: a batch reads and writes the keys it has, not all there are.
_KEYED_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FirstOfKey(StatefulProcessor):
    """Passes the first row of a key on, in the order (`_absent`, `_order`, `_tie`), once and for all batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            yield min(rows, key=_place)

    def close(self) -> None:
        pass


def _place(row: Row) -> tuple:
    return (True, 0, row["_tie"]) if row["_absent"] else (False, row["_order"], row["_tie"])


def cleaned(stream: DataFrame, order_key: str | None = None) -> DataFrame:
    """Clean texts with `text_key`, a hash of the text, and the row's place among its copies.

    The copy with the least order key comes first, one without it last, ties by a hash of all columns.
    """
    out = stream.withColumn("text", text.clean_text(F.col("text")))
    place = F.col(order_key) if order_key else F.lit(0)
    return out.withColumns(
        {
            "text_key": F.sha2(F.col("text"), 256),
            "_absent": place.isNull(),
            "_order": F.coalesce(place, F.lit(0)) if order_key is None else place,
            "_tie": F.xxhash64(*stream.columns),
        }
    )


def without_near_copies(rows: DataFrame, min_length: int) -> DataFrame:
    """One row per key and Arrow batch, of texts that are long enough.

    Copies of a very frequent text collapse before they are sent to its key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict = {}
            columns = (batch.column(c).to_pylist() for c in ("text", "text_key", "_absent", "_order", "_tie"))
            for i, (found, key, absent, order, tie) in enumerate(zip(*columns, strict=True)):
                if found is None or len(found) < min_length:
                    continue
                place = (True, 0, tie) if absent else (False, order, tie)
                if key not in first or place < first[key][0]:
                    first[key] = (place, i)
            yield batch.take(pa.array([i for _, i in first.values()], pa.int64()))

    return rows.mapInArrow(run, rows.schema)


def ingest(
    stream: DataFrame, out: str, checkpoint: str, order_key: str | None = None, min_length: int = fixed.MIN_TEXT_LENGTH
) -> StreamingQuery:
    """Process everything that has arrived, append rows whose text is new, stop.

    Which texts were seen is keyed state under `checkpoint`: a batch looks up the keys of its own texts, so its work
    does not grow with what came before, however old. Every batch owns the folder `batch=<number>` of `out`, so a
    batch repeated after a failure replaces its own rows; state and offsets go back with it.
    """
    spark = stream.sparkSession
    rows = without_near_copies(cleaned(stream, order_key), min_length)
    fresh = rows.groupBy("text_key").transformWithState(FirstOfKey(), outputStructType=rows.schema, outputMode="append", timeMode="none")

    def write(batch: DataFrame, number: int) -> None:
        batch.drop("_absent", "_order", "_tie").write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _KEYED_STATE)
    try:
        # A started query has the settings of this moment.
        return fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)

"""Benchmark decontamination by spaced-seed hashing.

A mask is a window of word positions of which some are ignored, so a hash of the others survives
substitutions at the ignored ones. Hashes of benchmark items and of training documents meet in a join, and
every hit is verified on its diagonal: the item is laid over the document there and the agreeing positions
are counted, so that substitutions anywhere are tolerated up to a set share.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.llm.words import mixed, text_or_empty, word_hashes
from murmuro.runtime import written

# Whatever words are exchanged in a stretch that counts as an overlap, one of these hits it somewhere. Chosen by an
# exhaustive search over masks of up to 12 words; no three that use seven words do so.
MASKS = ("11010111", "11101100001", "101000010111")
# An overlap counts from so many words in a row laid over each other, of which such a share agrees.
LEAST_WORDS, LEAST_AGREEING = 13, 0.8
# Items of fewer words say nothing about where they come from and overlap nothing.
LEAST_ITEM = 5
# Bits and probes of the filter that hashes of the corpus must pass before they are shuffled: 16 MB whatever the benchmark.
FILTER_BITS, PROBES = 27, 4


def spaced_hashes(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """One hash for every position where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, number, np.uint64)
    # Words are hashes already: a sum with a factor for each place, scrambled once, tells them apart.
    factors = mixed(np.arange(1, len(mask) + 1, dtype=np.uint64)) | np.uint64(1)
    for i, used in enumerate(mask):
        if used == "1":
            out += words[i : i + n] * factors[i]
    return mixed(out)


def whole_masks(n: int, share: float) -> list[tuple[str, int]]:
    """(mask, number) over all words of an item of `n` words that hit wherever such a share of them agrees.

    The first and last word agree. The others fall into two groups more than words may differ, and each mask
    ignores as many groups as words may differ, so one of them ignores every word that does.
    """
    differ = int((1 - share) * n + 1e-9)
    groups = min(differ + 2, n - 2)
    masks = []
    for ignored in combinations(range(groups), min(differ, groups)):
        masks.append("1" + "".join("0" if i % groups in ignored else "1" for i in range(n - 2)) + "1")
    return [(m, 1_000 * n + k) for k, m in enumerate(masks)]


def _probes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    step = mixed(hashes) | np.uint64(1)
    for k in range(PROBES):
        yield (hashes + np.uint64(k) * step) >> np.uint64(64 - FILTER_BITS)


def item_hashes(items: DataFrame, share: float = LEAST_AGREEING) -> DataFrame:
    """(item, hash, at) of benchmark rows (item, text): every mask at every position, a short item's own masks too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = [(np.empty(0, np.int64),) * 3]
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = word_hashes(text)
                kinds = [(m, k) for k, m in enumerate(MASKS)] if len(words) >= LEAST_ITEM else []
                if LEAST_ITEM <= len(words) < LEAST_WORDS:
                    kinds += whole_masks(len(words), share)
                for mask, k in kinds:
                    h = spaced_hashes(words, mask, k)
                    out.append((np.full(len(h), item), h.view(np.int64), np.arange(len(h))))
            item, hash_, at = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(hash_), pa.array(at)], ["item", "hash", "at"])

    return items.select("item", "text").mapInArrow(run, "item bigint, hash bigint, at bigint").distinct()


def item_words(items: DataFrame) -> DataFrame:
    """(item, item_words): the word hashes of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t).view(np.int64) for t in batch.column("text").to_pylist()]
            words = pa.array(words, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), words], ["item", "item_words"])

    return items.select("item", "text").mapInArrow(run, "item bigint, item_words array<bigint>")


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of FILTER_BITS bits over the hashes, built from the distinct bytes that hold a bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            for p in _probes(batch.column("hash").to_numpy().view(np.uint64)):
                np.bitwise_or.at(bits, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        place = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(bits[place].astype(np.int32))], ["place", "bits"])

    parts = hashes.select("hash").mapInArrow(run, "place bigint, bits int")
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    # At most one row per byte of the filter.
    found = parts.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return out


def document_hits(rows: DataFrame, bits: np.ndarray, short: list[int], share: float = LEAST_AGREEING) -> DataFrame:
    """(row, doc_id, words, hits) of documents with hashes that pass the filter; `short`: lengths of short items."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    schema = "row bigint, doc_id bigint, words array<bigint>, hits array<struct<hash: bigint, at: bigint>>"
    kinds = [(m, k) for k, m in enumerate(MASKS)] + [x for n in short for x in whole_masks(n, share)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out: list[tuple] = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_hashes(text)
                hits = []
                for mask, k in kinds:
                    h = spaced_hashes(words, mask, k)
                    at = np.arange(len(h))
                    for probe in range(PROBES):
                        if not len(h):
                            break
                        p = (h + np.uint64(probe) * (mixed(h) | np.uint64(1)) if probe else h) >> np.uint64(64 - FILTER_BITS)
                        keep = (known[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        h, at = h[keep], at[keep]
                    hits += zip(h.view(np.int64).tolist(), at.tolist(), strict=True)
                if hits:
                    out.append((row, doc_id, words.view(np.int64), [{"hash": a, "at": b} for a, b in hits]))
            if out:
                kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))
                types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), kind]
                columns = zip(*out, strict=True)
                names = ["row", "doc_id", "words", "hits"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return rows.select("row", "doc_id", "text").mapInArrow(run, schema)


def best_overlap(document: np.ndarray, item: np.ndarray, shift: int, least: int, share: float) -> tuple[int, int, int] | None:
    """(from, to, agreeing) of the longest stretch of the item at this shift that agrees well enough, or None.

    A stretch begins and ends with an agreeing word, holds `least` words (or the whole item, if shorter)
    and a `share` of agreeing ones. Found by prefix sums: agreeing words weigh 1 - share, others -share.
    """
    a, b = max(0, -shift), min(len(item), len(document) - shift)
    least = min(least, len(item))
    if b - a < least:
        return None
    same = document[a + shift : b + shift] == item[a:b]
    worth = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - share, -share))])
    # The longest stretch from i to j with worth[j] >= worth[i] that begins and ends with an agreeing word: i falls
    # along the running minimum of such places, j is the last such place that is worth as much.
    starts = np.flatnonzero(same)
    if not len(starts):
        return None
    ends, worth_there = starts + 1, worth[starts]
    falling = starts[worth_there == np.minimum.accumulate(worth_there)]
    best_after = np.maximum.accumulate(worth[ends][::-1])[::-1]
    last = len(ends) - np.searchsorted(best_after[::-1], worth[falling] - 1e-9, side="left") - 1
    k = int(np.argmax(ends[last] - falling))
    i, j = int(falling[k]), int(ends[last[k]])
    if j - i < least:
        return None
    agreeing = int(same[i:j].sum())
    return a + i, a + j, agreeing


def overlaps(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, share: float = LEAST_AGREEING
) -> DataFrame:
    """(row, doc_id, item_id, doc_from, n_words, n_agreeing): verified overlaps of keyed documents with items.

    The best overlap of each document and item, positions and lengths in words. Words are lower-cased
    without punctuation. An item of fewer than `least` words must be covered whole, those under LEAST_ITEM words overlap
    nothing; a missing text is empty. No overlap is missed for a `least` of LEAST_WORDS and a `share` of LEAST_AGREEING
    or more. Items of the same words are compared once and reported each.
    """
    listed = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_or_empty().alias("text"))
    # Items of one text are one item here.
    texts = listed.select("text").distinct().withColumn("item", F.monotonically_increasing_id())
    texts = written(texts, "items")
    hashes = written(item_hashes(texts, share), "item_hashes")
    lengths = written(item_words(texts), "item_words")
    short = [r.n for r in lengths.select(F.size("item_words").alias("n")).where(f"n >= {LEAST_ITEM} AND n < {LEAST_WORDS}").distinct().collect()]
    found = written(document_hits(docs, hash_filter(hashes), sorted(short), share), "hits")
    hits = found.select("row", F.explode("hits").alias("hit")).select("row", "hit.hash", F.col("hit.at").alias("doc_at"))
    places = hits.join(hashes, "hash")
    places = places.select("row", "item", (F.col("doc_at") - F.col("at")).alias("shift")).distinct()
    placed = places.join(lengths, "item").join(found.select("row", "doc_id", "words"), "row")

    # Only the stretch that the item covers is handed to Python.
    start = F.greatest(F.col("shift"), F.lit(0))
    end = F.least(F.col("shift") + F.size("item_words"), F.size("words").cast("bigint"))
    stretch = F.slice("words", (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))
    local = placed.select("row", "doc_id", "item", "shift", start.alias("start"), stretch.alias("stretch"), "item_words")
    names = ["row", "doc_id", "item", "doc_from", "n_words", "n_agreeing"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row, doc_id, item, shift, start, stretch, item_words = (c[i] for c in batch.columns)
                shift, start = shift.as_py(), start.as_py()
                here, there = (x.values.to_numpy(zero_copy_only=False) for x in (stretch, item_words))
                if best := best_overlap(here, there, shift - start, least, share):
                    out.append((row.as_py(), doc_id.as_py(), item.as_py(), best[0] + shift, best[1] - best[0], best[2]))
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    verified = local.mapInArrow(verify, ", ".join(f"{n} bigint" for n in names))
    best = verified.groupBy("row", "doc_id", "item").agg(
        F.max(F.struct("n_agreeing", "n_words", (-F.col("doc_from")).alias("back"))).alias("best")
    )
    named = texts.join(listed, "text").select("item", "item_id")
    return best.join(named, "item").select(
        "row", "doc_id", "item_id", (-F.col("best.back")).alias("doc_from"), "best.n_words", "best.n_agreeing"
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, share: float = LEAST_AGREEING
) -> DataFrame:
    """(doc_id, item_id, doc_from, n_words, n_agreeing): one row per document and benchmark item that overlap.

    Rows without a doc_id and repeated rows are reported like others. No documents or items give no rows.
    """
    from murmuro.llm.words import keyed

    return overlaps(keyed(docs, "texts"), benchmark, least, share).drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that overlap no benchmark item."""
    from murmuro.llm.words import free_name

    key = free_name(docs.columns, "row")
    stored = written(docs.withColumn(key, F.monotonically_increasing_id()), "docs")
    rows = stored.select(F.col(key).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    leaks = written(overlaps(rows, benchmark).select(F.col("row").alias(key)).distinct(), "leaks")
    # The same plan at every size.
    return stored.join(leaks.hint("merge"), key, "left_anti").drop(key)

"""Near-duplicate removal with HyperMinHash sketches.

A document is the set of its distinct word shingles. Every shingle hash names one of BUCKETS buckets by its
first bits; of the least hash of a bucket a sketch keeps only how many zeros lead it and the bits behind the
first one, 16 bits in all. Empty buckets borrow from a filled one in a fixed random order. Bands of registers
bring documents together, the registers' agreement, corrected for chance collisions, tells which of them may
be similar, and full sets confirm every link.

Texts with the same set form a class that takes part once. Classes that meet in a bucket of a band are told
apart in blocks of bounded size; what passes ties classes into candidate groups. A group within one block is
compared at once. A larger one is compared inside its blocks, twice with different blocks, which joins any
group of mutual copies at a cost that grows with its size. Only where a group still falls into several
components are the pairs between blocks compared too, so that no link is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro.llm.jaccard_join import _roots, _runs, _starts, compare_sets, components
from murmuro.llm.words import PIECE, REMEMBERED, keyed, mixed, shingles
from murmuro.runtime import written

WORDS, SIMILARITY = 3, 0.85
# Registers of a sketch, and the bits behind the leading one that each of them keeps.
BUCKETS, MANTISSA = 128, 10
# A pair exactly at the threshold shares a band with this chance at least.
RECALL = 0.99999
# A pair whose estimate lies so many standard deviations below the threshold is not a candidate.
DEVIATIONS = 5.0
# Classes compared with each other in one task (two blocks at most).
BLOCK = 512

_VALUE_BITS = 53
# A-Z to a-z, and the six ASCII blanks to one of them.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def word_ids(text: bytes) -> np.ndarray:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of a UTF-8 text with A-Z lower-cased, in order."""
    parts, start = [], 0
    while start < len(text) or not parts:
        end = start + PIECE
        if end < len(text):
            # A piece ends at the next blank, whichever of the six it is.
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
        words = text[start:end].translate(_PLAIN).split()
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
        start = end
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    return shingles(word_ids(text), words)


@cache
def _sources() -> np.ndarray:
    """For every bucket, the rank that each bucket has when a value is borrowed."""
    n = np.arange(BUCKETS * BUCKETS, dtype=np.uint64).reshape(BUCKETS, BUCKETS)
    return np.argsort(np.argsort(mixed(n + np.uint64(0x5851F42D4C957F2D)), axis=1), axis=1)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set: 0 where a bucket is empty, else zeros and mantissa of its least value, plus one."""
    bits = BUCKETS.bit_length() - 1
    hashes = np.sort(mixed(grams))
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    value = (hashes[first] << np.uint64(bits)) >> np.uint64(64 - _VALUE_BITS)
    fraction, exponent = np.frexp(value.astype(np.float64))
    zeros = _VALUE_BITS - exponent
    mantissa = np.where(value > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = (zeros << MANTISSA) + mantissa + 1
    return out


def densified(registers: np.ndarray) -> np.ndarray:
    """The registers with every empty bucket filled from the filled one that comes first in its random order."""
    empty, full = np.flatnonzero(registers == 0), np.flatnonzero(registers)
    if not len(empty):
        return registers
    out = registers.copy()
    out[empty] = registers[full[_sources()[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def choose_rows(similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows) over BUCKETS registers: the longest bands that find a pair at the threshold with this chance."""
    for rows in range(16, 0, -1):
        bands = BUCKETS // rows
        if bands and (1 - similarity**rows) ** bands <= 1 - recall:
            return bands, rows
    raise ValueError("too few registers for this recall")


@cache
def _collision_table() -> tuple[np.ndarray, np.ndarray]:
    """Log sizes, and the registers that two disjoint sets of that size agree on by chance."""
    sizes = 2.0 ** np.arange(0, 41)
    j = np.arange(1 << MANTISSA, dtype=np.float64)
    out = np.zeros(len(sizes))
    for zeros in range(1, _VALUE_BITS + 1):
        scale = BUCKETS * 2.0 ** (MANTISSA + zeros)
        low, high = ((1 << MANTISSA) + j) / scale, ((1 << MANTISSA) + j + 1) / scale
        for k, n in enumerate(sizes):
            out[k] += ((np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-high))) ** 2).sum()
    return np.log2(sizes), out * BUCKETS


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that disjoint sets of n and m members agree on by chance."""
    ratio = np.maximum(n, m) / np.minimum(n, m)
    return np.interp(np.log2(np.minimum(n, m)), *_collision_table()) * 4 * ratio / (1 + ratio) ** 2


def estimated(one: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates corrected for collisions, registers used) of sketches row by row; n and m are the sets' sizes."""
    same = ((one == other) & (one > 0)).sum(axis=1)
    used = ((one > 0) | (other > 0)).sum(axis=1)
    return (same - expected_collisions(n, m)) / np.maximum(used, 1), used


def sketched(rows: DataFrame, words: int) -> DataFrame:
    """(row, doc_id, same, n, registers) of keyed documents: hash of the set, its size, the sketch of a non-empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, sizes, registers = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                grams = shingle_set(text.as_py(), words)
                same.append(xxhash.xxh3_128_digest(grams.tobytes()))
                sizes.append(len(grams))
                registers.append(sketch(grams).tobytes() if len(grams) else None)
            columns = [pa.array(same, pa.binary()), pa.array(sizes, pa.int64()), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *columns], ["row", "doc_id", "same", "n", "registers"]
            )

    return rows.select("row", "doc_id", "text").mapInArrow(run, "row bigint, doc_id bigint, same binary, n bigint, registers binary")


def banded(classes: DataFrame, similarity: float) -> DataFrame:
    """(id, bucket): one row per class and band, the band's registers hashed together with its number."""
    bands, per_band = choose_rows(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            if not len(ids):
                continue
            stored = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(len(ids), BUCKETS)
            full = np.stack([densified(r) for r in stored]).astype(np.uint64)
            banded_ = full[:, : bands * per_band].reshape(len(ids), bands, per_band)
            keys = np.zeros((len(ids), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
            for k in range(per_band):
                keys = mixed(keys * np.uint64(31) + banded_[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, bands)), pa.array(keys.view(np.int64).ravel())], ["id", "bucket"]
            )

    return classes.select("id", "registers").mapInArrow(run, "id bigint, bucket bigint")


def _blocks(members: int | str, size: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(members, F.lit(seed)), F.ceil(size / BLOCK)).cast("int")


def _paired(rows: DataFrame, group: str, seed: int = 0) -> DataFrame:
    """Members (group, id, n_group, …) sent to the pairs of blocks a <= b of their group that hold their own."""
    others = F.sequence(F.lit(0), (F.ceil(F.col("n_group") / BLOCK) - 1).cast("int"))
    rows = rows.withColumn("own", _blocks("id", F.col("n_group"), seed)).withColumn("other", F.explode(others))
    rows = rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
    return rows.drop("other", "n_group")


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, "id")


def candidate_edges(classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that tie classes (id, n, registers) together which may be similar enough."""
    bands = written(banded(classes, similarity), "bands")
    # Buckets with the same members are one: most pairs of copies share many bands.
    buckets = bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_group"),
        F.bit_xor(F.xxhash64("id")).alias("_one"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("_two"),
    )
    buckets = buckets.where("n_group > 1").groupBy("n_group", "_one", "_two").agg(F.min("bucket").alias("bucket"))
    members = bands.join(written(buckets.select("bucket", "n_group"), "buckets").hint("merge"), "bucket")
    members = members.join(classes.select("id", "n", "registers").hint("merge"), "id")
    keys = ["bucket", "a", "b"]
    rows = _dealt(_paired(members, "bucket").select(*keys, "id", "n", "registers"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            starts = _starts(table, keys)
            ids, sizes = table.column("id").to_numpy(), table.column("n").to_numpy()
            marks = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(len(ids), BUCKETS)
            run_end = np.repeat(starts[1:], np.diff(starts))
            here = np.arange(len(ids))
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for gap in range(1, int(np.diff(starts).max())):
                here = here[here + gap < run_end[here]]
                n, m = sizes[here], sizes[here + gap]
                # Sets of too different sizes cannot be similar, whatever their members.
                fits = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9
                i, n, m = here[fits], n[fits], m[fits]
                score, used = estimated(marks[i], marks[i + gap], n, m)
                slack = DEVIATIONS * np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))
                i = i[score >= similarity - slack]
                left.append(i)
                right.append(i + gap)
            root = _roots(len(ids), np.concatenate(left), np.concatenate(right))
            tied = root != np.arange(len(ids))
            pairs = np.unique(np.stack([ids[tied], ids[root[tied]]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _confirmed(rows: DataFrame, keys: list[str], words: int, similarity: float) -> DataFrame:
    """(a, b) of members (id, root, text) of each run of the keys whose full sets are similar enough and whose roots differ.

    Enough of them to connect all that are connected in the run.
    """
    rows = _dealt(rows.select(*keys, "id", "root", "text"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            starts = _starts(table, keys)
            out = [np.empty((0, 2), np.int64)]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                ids, roots = table.column("id")[s:e].to_numpy(), table.column("root")[s:e].to_numpy()
                sets = [shingle_set(t.as_py(), words) for t in table.column("text")[s:e].cast(pa.binary())]
                for i, j, _ in compare_sets(sets, similarity):
                    new = roots[i] != roots[j]
                    root = _roots(len(ids), i[new], j[new])
                    tied = root != np.arange(len(ids))
                    out.append(np.stack([ids[tied], ids[root[tied]]], 1))
            pairs = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _rooted(texts: DataFrame, edges: DataFrame) -> DataFrame:
    """Members with the root that the edges found so far give them, themselves where there is none."""
    roots = components(edges).withColumnRenamed("root", "_root")
    found = texts.drop("root").join(roots.hint("merge"), "id", "left")
    return found.withColumn("root", F.coalesce("_root", "id")).drop("_root")


def linked(classes: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """(id, root) of the classes (id, n, registers) that have a link: the least id of those connected."""
    groups = components(candidate_edges(classes, similarity)).withColumnRenamed("root", "group")
    sizes = written(groups.groupBy("group").agg(F.count(F.lit(1)).alias("n_group")), "sizes")
    texts = groups.join(sizes.hint("merge"), "group")
    texts = texts.join(rows.select(F.col("row").alias("id"), "text").hint("merge"), "id")
    texts = written(texts.withColumn("root", F.col("id")), "candidates")
    size = F.col("n_group")
    edges = written(_confirmed(texts.withColumn("own", _blocks("id", size, 0)), ["group", "own"], words, similarity), "confirmed")
    large = texts.where(size > BLOCK)
    if not large.isEmpty():
        # Other blocks of the large groups: the parts that a block has joined meet anew.
        again = written(_rooted(large, edges), "large")
        more = _confirmed(again.withColumn("own", _blocks("id", size, 1)), ["group", "own"], words, similarity)
        edges = written(edges.unionByName(more), "confirmed")
        again = written(_rooted(large, edges), "large")
        parts = again.groupBy("group").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
        parts = written(parts.where("_low < _high").select("group"), "parts")
        # Groups still in parts: all pairs of blocks, but for those inside a block, which were compared first.
        open_ = _paired(again.join(parts.hint("merge"), "group"), "group").where("a < b")
        edges = written(edges.unionByName(_confirmed(open_, ["group", "a", "b"], words, similarity)), "confirmed")
    return components(edges)


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words are runs of anything but the six ASCII blanks, A-Z in lower case. A text of fewer than `words` words is
    one shingle. Missing texts and texts without words have no shingles and link to nothing. Documents are linked
    when their sets' Jaccard similarity is `similarity` or more, and equal sets are. `component_id` is the least
    doc_id that links lead to. Rows without a doc_id take part; where a component has no other it is null. Repeated
    rows each give a row. Other columns are left out. No rows give no rows.
    """
    rows = keyed(docs, "texts")
    sketches = written(sketched(rows, words), "sketches")
    # The class id is the least row of the class.
    classes = sketches.where("n > 0").groupBy("same").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("registers").alias("registers")
    )
    classes = written(classes, "classes")
    roots = linked(classes.select("id", "n", "registers"), rows, words, similarity)
    members = classes.select("same", "id", "least").join(roots.hint("merge"), "id", "left")
    members = written(members.select("same", "least", F.coalesce("root", "id").alias("root")), "members")
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = written(members.join(least.hint("merge"), "root").select("same", "component_id"), "components")
    with_words = sketches.where("n > 0").select("doc_id", "n", "same").join(of_class.hint("merge"), "same")
    without = sketches.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = with_words.select("doc_id", "n", "component_id").unionByName(without)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

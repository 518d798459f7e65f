"""Line de-duplication by pairwise alignment.

Every line with enough words that occurs in more than one document points to the first document that has
it. So does every shorter line together with the lines up to the next longer one on either side, because it
is common to two documents only in a block that holds these. So a document is paired with those earlier ones
that own its shared lines and runs: two pairs at most per line it has, however common the line, and copies of
one text all pair with the first copy. Each pair is aligned by
patience diff, and the aligned blocks are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.llm.words import WORD, keyed
from murmuro.operators.order import prefix_sum, row_numbers
from murmuro.runtime import written

# Words from which on a line can pair documents and can be deleted together with its neighbours.
LEAST_WORDS = 5


def line_hash(line: str, least: int = LEAST_WORDS) -> int:
    """Hash of a line's lower-cased words; odd for a line of enough words, even for a shorter one."""
    words = WORD.findall(line.lower())
    value = xxhash.xxh64_intdigest(" ".join(words)) >> 1
    return value | 1 if len(words) >= least else value & ~1


def runs_of(lines: list[int]) -> set[int]:
    """Hashes of the runs from each short line to the nearest line of enough words before it, and behind it."""
    out = set()
    for side, stretch in enumerate((lines, lines[::-1])):
        run = None
        for x in stretch:
            if x & 1:
                run = x
            elif run is not None:
                # The hash of a tuple of numbers is the same in every process.
                run = hash((side, run, x))
                out.add(run)
    return out


def hashed_lines(rows: DataFrame, least: int) -> DataFrame:
    """(row, doc_id, lines, runs) of keyed documents: the hash of every line, and those of `runs_of`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[line_hash(x, least) for x in t.as_py().split("\n")] for t in batch.column("text")]
            lists = pa.array(found, pa.list_(pa.int64()))
            runs = pa.array([list(runs_of(x)) for x in found], pa.list_(pa.int64()))
            columns = [batch.column("row"), batch.column("doc_id"), lists, runs]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "lines", "runs"])

    schema = "row bigint, doc_id bigint, lines array<bigint>, runs array<bigint>"
    return rows.select("row", "doc_id", "text").mapInArrow(run, schema)


def _unique(lines: list[int], a: int, b: int) -> dict[int, int]:
    """Where the lines stand that occur once in the stretch."""
    counts = Counter(lines[a:b])
    return {lines[i]: i for i in range(a, b) if counts[lines[i]] == 1}


def _first(lines: list[int], a: int, b: int) -> dict[int, int]:
    """Where each line of the stretch stands first."""
    return {lines[i]: i for i in range(b - 1, a - 1, -1)}


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises on both sides (pairs come sorted by the first)."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        i = bisect_left(tops, y)
        if i == len(tops):
            tops.append(y)
            at.append(k)
        else:
            tops[i], at[i] = y, k
        back[k] = at[i - 1] if i else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def aligned(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Patience diff: positions of equal lines that are laid on each other.

    Equal heads and tails are matched, then lines unique on both sides in their longest common order (where
    there are none, the first of the repeated ones), then the stretches between those, each by the same rule. The
    work list stands in for recursion.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        for places in (_unique, _first):
            here, there = places(left, a, b), places(right, c, d)
            if anchors := _rising(sorted((i, there[x]) for x, i in here.items() if x in there)):
                break
        else:
            continue
        out += anchors
        p, q = a, c
        for i, j in [*anchors, (b, d)]:
            if i > p and j > q:
                todo.append((p, i, q, j))
            p, q = i + 1, j + 1
    return sorted(out)


def common_positions(later: list[int], earlier: list[int]) -> list[int]:
    """Positions of the later document in aligned blocks that hold at least one line of enough words.

    A block is a run of lines that follow each other on both sides. What an alignment leaves is aligned
    again until nothing is found, so blocks that changed places or stand twice are found too.
    """
    out: list[int] = []
    rest, known = list(range(len(later))), set(earlier)
    while True:
        rest = [x for x in rest if later[x] in known]
        found: list[int] = []
        block: list[tuple[int, int]] = []
        for i, j in [*((rest[i], j) for i, j in aligned([later[x] for x in rest], earlier)), (-1, -1)]:
            if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                if any(later[x] & 1 for x, _ in block):
                    found += [x for x, _ in block]
                block = []
            block.append((i, j))
        if not found:
            return sorted(out)
        out += found
        gone = set(found)
        rest = [x for x in rest if x not in gone]


def overlapping_pairs(lines: DataFrame) -> DataFrame:
    """(place, first): each document with the earlier documents that were the first to hold one of its lines or runs.

    `lines`: (place, lines, runs) with `place` the document's number in order. The holders are found by
    counting before any join, and only lines in two documents or more are joined.
    """
    held = F.array_distinct(F.concat(F.filter("lines", lambda x: x % 2 == 1), "runs"))
    held = lines.select("place", F.explode(held).alias("line"))
    shared = held.groupBy("line").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shared.drop("n"), "shared")
    return held.join(shared, "line").where("first < place").select("place", "first").distinct()


def places_in_order(lines: DataFrame) -> DataFrame:
    """(row, place): documents numbered by doc_id, those without one last, rows of one doc_id by their row.

    Ids are counted and numbered first; only ids of several rows need a number inside, and those rows are
    numbered by a sum over value ranges too, so a hot id (or very many rows without one) is no single task's.
    """
    ids = lines.select("row", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"))
    counts = written(ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "ids")
    starts = written(prefix_sum(counts, "id", "n", "start"), "starts").select("id", "start", "n")
    joined = written(ids.join(starts, "id"), "ids")
    once = joined.where("n = 1").select("row", F.col("start").alias("place"))
    several = row_numbers(joined.where("n > 1").select("row", "id", "start"), "row", "nth")
    # Among repeated rows alone, the numbers of one id need not be dense: they only have to rise.
    least = written(several.groupBy("id").agg(F.min("nth").alias("low")), "lows")
    several = several.join(least, "id").select("row", (F.col("start") + F.col("nth") - F.col("low")).alias("place"))
    return once.unionByName(several)


def deletions(rows: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(row, places, partners): line positions to delete from keyed documents, and the doc_ids they align with."""
    lines = written(hashed_lines(rows, least), "lines")
    placed = written(lines.join(written(places_in_order(lines), "order"), "row"), "placed")
    pairs = written(overlapping_pairs(placed.select("place", "lines", "runs")), "pairs")
    later = placed.select("place", "row", F.col("lines").alias("later"))
    earlier = placed.select(F.col("place").alias("first"), F.col("doc_id").alias("partner"), F.col("lines").alias("earlier"))
    both = pairs.join(earlier, "first").join(later, "place").select("row", "partner", "later", "earlier")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row, partner, a, b = (c[i] for c in batch.columns)
                out.append((row.as_py(), partner.as_py(), common_positions(a.as_py(), b.as_py())))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            types = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "partner", "places"])

    found = both.mapInArrow(run, "row bigint, partner bigint, places array<int>").where(F.size("places") > 0)
    # A document has two partners at most per line of its own.
    return found.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        F.array_sort(F.collect_set("partner")).alias("partners"),
    )


def without_common_blocks(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text, n_lines, n_deleted, partners) of every document, common blocks deleted.

    Of two documents the one with the greater doc_id is the later; rows of one doc_id in the order of
    the files, rows without a doc_id last. A later copy of a whole text becomes empty. Lines are cut at
    line breaks and compared by their lower-cased words. `partners`: doc_ids of the documents whose blocks
    were deleted here. A missing text is empty, has one line and loses none. Repeated rows each give a row,
    and other columns are left out. No rows give no rows.
    """
    rows = keyed(docs, "texts")
    gone = written(deletions(rows, least), "deletions")
    # One plan at every size: row is a key, so nothing is skewed.
    joined = rows.join(gone.hint("merge"), "row", "left").select("doc_id", "text", "places", "partners")
    names = ["doc_id", "text", "n_lines", "n_deleted", "partners"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_deleted = [], [], []
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                kept = lines = text.as_py().split("\n")
                if places.is_valid:
                    drop = np.ones(len(lines), bool)
                    drop[places.values.to_numpy()] = False
                    kept = [x for x, keep in zip(lines, drop, strict=True) if keep]
                texts.append("\n".join(kept))
                n_lines.append(len(lines))
                n_deleted.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_deleted, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, batch.column("partners")], names)

    schema = "doc_id bigint, text string, n_lines bigint, n_deleted bigint, partners array<bigint>"
    out = joined.withColumn("partners", F.coalesce("partners", F.array().cast("array<bigint>")))
    return out.mapInArrow(run, schema)

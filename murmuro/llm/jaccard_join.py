"""Join of documents by the Jaccard similarity of their word n-grams, with MinHash banding.

Texts of the same words form a class, and each class takes part once. A class's n-grams give a MinHash
signature, cut into bands; classes that agree on a whole band meet in a bucket. Buckets are worked off in
blocks of bounded size, where signatures that cannot belong to a pair are told apart, and what is left
ties classes into candidate groups. Inside a group every two classes are compared by their full n-gram sets,
again block by block, so a large group is spread over many tasks and no task holds more than two blocks.
Links are counted where they are found: the rows that leave a task grow with its documents, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.llm.words import keyed, mixed, shingles, word_hashes
from murmuro.runtime import written

WORDS, SIMILARITY = 5, 0.8
# Chance that a pair exactly at the threshold shares a band, and the longest signature to reach it with.
RECALL, MOST_HASHES = 0.9999, 96
# Classes of a bucket or group that are compared with each other in one task (two blocks at most).
BLOCK = 512
# Edges that a task of a connecting step has, about, and shuffle partitions that one task takes at most.
TASK_EDGES, MERGED = 50_000, 16
# n-grams of a block that are multiplied at a time.
COLUMNS = 4_096


def choose_bands(similarity: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair at the threshold with the given chance."""
    for rows in range(16, 0, -1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows))))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("the signature is too short for this recall")


def _signatures(grams: list[np.ndarray], n: int) -> np.ndarray:
    """MinHash signatures of non-empty n-gram sets, n hashes each, taken set by set over one long array."""
    out = np.empty((len(grams), n), np.uint64)
    seeds = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd = mixed(seeds) | np.uint64(1)
    step = 1 << 18
    sizes = np.asarray([len(g) for g in grams])
    at = 0
    while at < len(grams):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), step)) + at)
        joined = mixed(np.concatenate(grams[at:upto]))
        starts = np.concatenate([[0], np.cumsum(sizes[at : upto - 1])]).astype(np.int64)
        for k in range(n):
            out[at:upto, k] = np.minimum.reduceat((joined ^ seeds[k]) * odd[k], starts)
        at = upto
    return out


def signed(rows: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """(row, doc_id, same, marks, bands) of keyed documents: class key, one byte of each hash, a hash of each band.

    A text without words has no signature: such texts are one class and link to nothing.
    """
    schema = "row bigint, doc_id bigint, same binary, marks binary, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                same, grams = [], []
                for text in part.column("text"):
                    ids = word_hashes(text.as_py())
                    same.append(xxhash.xxh3_128_digest(ids.tobytes()))
                    grams.append(shingles(ids, words))
                full = [i for i, g in enumerate(grams) if len(g)]
                marks: list = [None] * len(grams)
                keys: list = [None] * len(grams)
                if full:
                    sig = _signatures([grams[i] for i in full], bands * per_band)
                    small = (sig >> np.uint64(56)).astype(np.uint8)
                    banded = sig.reshape(len(full), bands, per_band)
                    mixed_ = np.zeros((len(full), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                    for k in range(per_band):
                        mixed_ = mixed(mixed_ * np.uint64(31) + banded[:, :, k])
                    for j, i in enumerate(full):
                        marks[i], keys[i] = small[j].tobytes(), mixed_[j].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(same, pa.binary()), pa.array(marks, pa.binary())]
                    + [pa.array(keys, pa.list_(pa.int64()))],
                    ["row", "doc_id", "same", "marks", "bands"],
                )

    return rows.select("row", "doc_id", "text").mapInArrow(run, schema)


def in_blocks(df: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """Rows with the columns `a`, `b`: each member goes to the block pairs (a <= b) of its group that hold its block."""
    sizes = written(df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "sizes")
    own = F.pmod(F.xxhash64(member), F.ceil(F.col("_n") / block)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("_n") / block) - 1).cast("int")))
    rows = df.join(sizes.hint("merge"), group).withColumn("own", own).withColumn("other", other)
    return rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("_n", "other")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole key runs from sorted batches."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        first, last = key(batch, 0), key(batch, batch.num_rows - 1)
        if held and (key(held[-1], held[-1].num_rows - 1) != first):
            yield pa.Table.from_batches(held)
            held = []
        if first == last:
            held.append(batch)
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
        cut = int(np.flatnonzero(changed)[-1])
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.ones(table.num_rows + 1, bool)
    changed[1:-1] = False
    for k in keys:
        v = table.column(k).to_numpy()
        changed[1:-1] |= v[1:] != v[:-1]
    return np.flatnonzero(changed)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each of n members' connected group, given the linked pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        for side in (root[i], root[j], i, j):
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def candidate_edges(signs: DataFrame, similarity: float) -> DataFrame:
    """(a, b) pairs of class ids that tie classes together which may be similar enough.

    `signs`: (id, marks, bands) of one row per class. Two signatures of a bucket pass when they agree on as
    many hashes as a pair at the threshold has but for one chance in a million.
    """
    meets = signs.select("id", "marks", F.explode("bands").alias("bucket"))
    rows = in_blocks(meets, "bucket", "id", BLOCK)
    rows = rows.select("bucket", "a", "b", "id", "marks").repartition("bucket", "a", "b")
    rows = rows.sortWithinPartitions("bucket", "a", "b", "id")
    keys = ["bucket", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            starts = _starts(table, keys)
            ids = table.column("id").to_numpy()
            joined = table.column("marks").combine_chunks()
            marks = np.frombuffer(b"".join(joined.to_pylist()), np.uint8).reshape(len(ids), -1)
            n = marks.shape[1]
            least = n * similarity - 5 * math.sqrt(n * similarity * (1 - similarity))
            run_end = np.repeat(starts[1:], np.diff(starts))
            here = np.arange(len(ids))
            left, right = [], []
            for gap in range(1, int(np.diff(starts).max())):
                here = here[here + gap < run_end[here]]
                near = here[(marks[here] == marks[here + gap]).sum(axis=1) >= least]
                left.append(near)
                right.append(near + gap)
            i = np.concatenate(left) if left else np.empty(0, np.int64)
            j = np.concatenate(right) if right else np.empty(0, np.int64)
            root = _roots(len(ids), i, j)
            pairs = np.unique(np.stack([ids, ids[root]], 1)[root != np.arange(len(ids))], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of an edge (a, b): root is the least id of its connected group.

    Alternating steps: every node ties its larger neighbours to its least one, then its smaller ones, until
    each node has one edge, to a node that has none. Each step is an aggregation and a join over the edges,
    written to the shared folder. A node with very many neighbours only ever needs their minimum, which is
    found before the shuffle.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    # No step makes more edges than there are; few of them need few tasks, however many partitions a shuffle has.
    partitions = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-edges.count() // TASK_EDGES), -(-partitions // MERGED))

    def kept(df: DataFrame, label: str) -> DataFrame:
        return written(df.coalesce(tasks), label)

    while not _stars(edges, tasks):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.where("a != b").distinct(), "large")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = kept(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return kept(edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots), "roots")


def _stars(edges: DataFrame, tasks: int) -> bool:
    """Has every node one edge at most, to a node without one?"""
    tops = edges.select(F.col("b").alias("id"), F.lit(1).alias("top"), F.lit(0).alias("n"))
    nodes = edges.select(F.col("a").alias("id"), F.lit(0).alias("top"), F.lit(1).alias("n")).unionByName(tops)
    nodes = nodes.groupBy("id").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    return nodes.where("n > 1 OR n = 1 AND top = 1").coalesce(tasks).isEmpty()


def compare_sets(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, Jaccard) of the pairs at or above the threshold, i < j. Sets are sorted and distinct."""
    sizes = np.asarray([len(s) for s in sets])
    n = len(sets)
    if n == 2:
        common = np.asarray([[0, len(np.intersect1d(*sets, assume_unique=True))], [0, 0]])
    else:
        _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), sizes)
        place = np.cumsum(uses > 1) - 1
        kept = (uses > 1)[column]
        owner, column = owner[kept], place[column[kept]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((n, n), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [at, at + COLUMNS])
            part = np.zeros((n, COLUMNS), np.float32)
            part[owner[a:b], column[a:b] - at] = 1
            common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    score = common / np.maximum(union, 1)
    i, j = np.nonzero(np.triu(score >= similarity - 1e-6, 1))
    exact = np.rint(common[i, j]) / (sizes[i] + sizes[j] - np.rint(common[i, j]))
    good = exact >= similarity
    yield i[good], j[good], exact[good]


def _compared(groups: DataFrame, words: int, similarity: float, emit: Callable, schema: str) -> DataFrame:
    """Compare (root, id, text) inside each root, block by block; `emit` makes the rows of one block pair."""
    rows = in_blocks(groups, "root", "id", BLOCK).select("root", "a", "b", "own", "id", "text")
    rows = rows.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "id")
    keys = ["root", "a", "b"]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            starts = _starts(table, keys)
            out: list[list[np.ndarray]] = [[] for _ in names]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                ids, own = table.column("id")[s:e].to_numpy(), table.column("own")[s:e].to_numpy()
                one_block = table.column("a")[s].as_py() == table.column("b")[s].as_py()
                sets = [shingles(word_hashes(t.as_py()), words) for t in table.column("text")[s:e]]
                for i, j, score in compare_sets(sets, similarity):
                    fresh = slice(None) if one_block else own[i] != own[j]  # same-block pairs have a task of their own
                    for k, v in enumerate(emit(ids, i[fresh], j[fresh], score[fresh])):
                        out[k].append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out], names)

    return rows.mapInArrow(run, schema)


class JaccardJoin:
    """The join over one table of documents, as steps that can be asked for separately."""

    def __init__(
        self, docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, stored: DataFrame | None = None
    ) -> None:
        self.words, self.similarity = words, similarity
        bands, per_band = choose_bands(similarity, recall, MOST_HASHES)
        self.rows = keyed(docs, "texts") if stored is None else stored
        self.signs = written(signed(self.rows, words, bands, per_band), "signatures")
        # The class id inside the join is the least row of the class.
        self.classes = written(
            self.signs.groupBy("same").agg(
                F.min("row").alias("id"), F.min("doc_id").alias("class_id"), F.first("marks").alias("marks"), F.first("bands").alias("bands")
            ),
            "classes",
        )
        edges = candidate_edges(self.classes.where("marks IS NOT NULL").select("id", "marks", "bands"), similarity)
        self.groups = components(edges)

    def _texts(self) -> DataFrame:
        # The same plan at every size: both sides meet by id.
        return self.groups.join(self.rows.select(F.col("row").alias("id"), "text").hint("merge"), "id")

    def pairs(self) -> DataFrame:
        """(class_a, class_b, jaccard) between classes; grows with the links themselves."""

        def emit(ids, i, j, score):
            return ids[i], ids[j], score

        found = _compared(self._texts(), self.words, self.similarity, emit, "a bigint, b bigint, jaccard double")
        names = self.classes.select("id", "class_id")
        return (
            found.join(names.select(F.col("id").alias("a"), F.col("class_id").alias("class_a")), "a")
            .join(names.select(F.col("id").alias("b"), F.col("class_id").alias("class_b")), "b")
            .select("class_a", "class_b", "jaccard")
        )

    def linked(self) -> DataFrame:
        """(id, n_links, root): for each class with links how many, and the least class of its linked group."""

        def emit(ids, i, j, score):
            links = np.bincount(np.concatenate([i, j]), minlength=len(ids))
            root = ids[_roots(len(ids), i, j)]
            some = links > 0
            return ids[some], links[some], root[some]

        found = _compared(self._texts(), self.words, self.similarity, emit, "id bigint, links bigint, root bigint")
        found = written(found, "links")
        counts = found.groupBy("id").agg(F.sum("links").alias("n_links"))
        roots = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
        return counts.join(roots, "id")

    def members(self) -> DataFrame:
        """(row, doc_id, class_id, n_links, group): `group` is the least row among classes linked to each other."""
        linked = written(self.linked(), "linked")
        classes = self.classes.select("same", "id", "class_id").join(linked, "id", "left")
        classes = classes.select(
            "same", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "id").alias("group")
        )
        classes = written(classes, "class_links")
        return self.signs.select("row", "doc_id", "same").join(classes, "same").drop("same")


def jaccard_links(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, n_links, group_id) for every document.

    `class_id`: the least doc_id among documents of the same words in the same order (lower-cased, without
    punctuation). `n_links`: other classes whose distinct word n-grams have the given Jaccard similarity or
    more; a text shorter than n words is one n-gram. `group_id`: the least class_id over all classes tied by links.

    Missing texts are empty; texts without words are one class without links. Rows without a doc_id take
    part, and class_id is null where a class has no doc_id. Repeated rows each give a row. Other columns
    are left out. No rows give no rows.
    """
    members = written(JaccardJoin(docs, words, similarity).members(), "members")
    groups = written(members.groupBy("group").agg(F.min("class_id").alias("group_id")), "groups")
    return members.join(groups, "group").select("doc_id", "class_id", "n_links", "group_id")


def one_of_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each linked group stays.

    The one with the least doc_id stays (of several such rows any one, the same on every run over the same
    files); rows without a doc_id only where a group has no other.
    """
    from murmuro.llm.words import free_name, text_or_empty

    key = free_name(docs.columns, "row")
    stored = written(docs.withColumn(key, F.monotonically_increasing_id()), "docs")
    rows = stored.select(F.col(key).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    members = written(JaccardJoin(docs, words, similarity, stored=rows).members(), "members")
    first = members.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias(key))
    # The same plan at every size.
    return stored.join(written(first.select(key), "kept").hint("merge"), key, "left_semi").drop(key)

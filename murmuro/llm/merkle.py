"""Merkle manifest of a data set, with nested-interval labels.

Every row is a leaf, ranked inside its tree (one tree per language). A node carries the interval [lo, hi) of
the leaf ranks it covers: at level k that is the run of FAN ** k ranks that starts at a multiple of it. A
node of level k lies under the node of level k + 1 in whose bucket, lo div FAN ** (k + 1), it falls, and whose
interval contains its own: one equi-join per level attaches the ancestors, from the roots downwards, and no key
of such a join has more than FAN rows. What a parent's interval has besides the node's own is its siblings.
The subroots are the leaves of one more tree, whose root stands for everything.

Ranks come from a sort by value ranges and a running sum over one row per range and tree, so neither a tree nor
a run of equal rows ever meets in one task. Levels are written to the shared folder; each has an eighth of the
rows of the one below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro.llm.words import free_name
from murmuro.runtime import lookup_join, written

FAN = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Of an ancestor, its children outside the node's interval: digests before it and after it, left to right.
_STEP = "struct<before: string, after: string>"


def digest_of(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 length, a colon and itself; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    return digest_of(*[field(text if c == "text" else F.col(c)) for c in FIELDS])


def tampered_with(doc_id: Column) -> Column:
    """Is this document's text changed before its proof is folded? Never without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Add `lo`, the rank from 0 inside `tree`, and `n`, the tree's number of leaves. Written.

    Equal rows are told apart by their place in the input, so they may lie in several value ranges.
    """
    place = free_name(leaves.columns, "_place")
    keys = ["tree", *order, place]
    rows = leaves.withColumn(place, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(place)
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # The id counts the rows of a task; its upper bits are the task, and tasks follow the order of the ranges.
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = written(rows.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")), "runs")
    # A tree has one row per range here; a whole window over them is as long as the write had tasks.
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("n"),
        "_rows",
    )
    rows = lookup_join(rows, written(runs, "shifts"), ["tree", "_part"], spread=["_at"], weight="_rows")
    return rows.withColumn("lo", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_part")


def span(level: int) -> int:
    """Leaves under a full node of this level."""
    return FAN**level


def families(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of `level` (tree, n, lo, hi, digest, children) over the given ones of the level below."""
    kept = [c for c in nodes.columns if c not in ("tree", "n")]
    runs = nodes.groupBy("tree", "n", F.expr(f"lo div {span(level)}").alias("run"))
    runs = runs.agg(F.sort_array(F.collect_list(F.struct("lo", *[c for c in kept if c != "lo"]))).alias("children"))
    return runs.select(
        "tree",
        "n",
        (F.col("run") * span(level)).alias("lo"),
        F.least((F.col("run") + 1) * span(level), "n").alias("hi"),
        digest_of(F.array_join("children.digest", "")).alias("digest"),
        "children",
    )


class Forest:
    """All trees over ranked leaves (tree, lo, n, digest and more columns), level by level."""

    def __init__(self, leaves: DataFrame) -> None:
        self.leaves = leaves.withColumn("hi", F.col("lo") + 1)
        most = leaves.agg(F.max("n")).first()[0] or 0
        self.levels: list[DataFrame] = []
        nodes = self.leaves
        while span(len(self.levels)) < most:
            level = len(self.levels) + 1
            # A tree that has come down to one node has its root.
            self.levels.append(written(families(nodes.where(F.col("n") > span(level - 1)), level), f"level{level}"))
            nodes = self.levels[-1].select("tree", "n", "lo", "hi", "digest")

    def roots(self) -> DataFrame:
        """(tree, digest) of each tree: its only leaf, or the node that covers all of it."""
        out = self.leaves.where("n = 1").select("tree", "digest")
        for level in self.levels:
            out = out.unionByName(level.where("lo = 0 AND hi = n").select("tree", "digest"))
        return out

    def attached(self, tops: DataFrame) -> DataFrame:
        """The leaves with `path`, an array of steps from the leaf upwards, and all columns of `tops`.

        `tops`: (tree, path, …), what lies above each tree's root; one row per tree.
        """
        more = [c for c in tops.columns if c not in ("tree", "path")]
        above = None
        for k in range(len(self.levels), 0, -1):
            nodes = self.levels[k - 1]
            at_top = lookup_join(nodes.where("lo = 0 AND hi = n"), tops, "tree")
            if above is None:
                above = at_top
            else:
                below = nodes.where("NOT (lo = 0 AND hi = n)").withColumn("bucket", F.expr(f"lo div {span(k + 1)}"))
                parents = above.select(
                    F.col("tree").alias("_tree"),
                    F.expr(f"lo div {span(k + 1)}").alias("_bucket"),
                    F.col("lo").alias("_lo"),
                    F.col("hi").alias("_hi"),
                    # Only what a child needs goes up and down: intervals and digests of its family.
                    F.transform("children", lambda c: F.struct(c.lo.alias("lo"), c.hi.alias("hi"), c.digest.alias("digest"))).alias("_family"),
                    "path",
                    *more,
                )
                inside = "tree = _tree AND bucket = _bucket AND _lo <= lo AND hi <= _hi"
                joined = below.join(parents.hint("merge"), F.expr(inside))
                path = F.concat(F.array(_step("_family", F.col("lo"), F.col("hi"))), "path")
                above = joined.select(*[c for c in at_top.columns if c not in ("path", *more)], path.alias("path"), *more).unionByName(at_top)
        lone = lookup_join(self.leaves.where("n = 1"), tops, "tree")
        if above is None:
            return lone
        # The family is exploded from its node: a leaf meets its parent without another shuffle.
        own = [c for c in self.leaves.columns if c not in ("tree", "n")]
        rows = above.select("tree", "n", "path", *more, F.col("children").alias("_family"), F.explode("children").alias("_leaf"))
        path = F.concat(F.array(_step("_family", F.col("_leaf.lo"), F.col("_leaf.hi"))), "path")
        rows = rows.select("tree", "n", *[F.col(f"_leaf.{c}").alias(c) for c in own], path.alias("path"), *more)
        return rows.unionByName(lone)


def _step(family: str, lo: Column, hi: Column) -> Column:
    """The siblings of [lo, hi): the parts of its parent's interval before and after it."""
    before = F.filter(family, lambda c: c["hi"] <= lo)
    after = F.filter(family, lambda c: c["lo"] >= hi)
    return F.struct(
        F.array_join(F.transform(before, lambda c: c["digest"]), "").alias("before"),
        F.array_join(F.transform(after, lambda c: c["digest"]), "").alias("after"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda digest, step: digest_of(step["before"], digest, step["after"]))


def siblings(path: Column) -> Column:
    """All sibling digests of a proof in a row."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Leaves hash doc_id, source, lang, n_chars and the whole text. Per language they ascend by doc_id, rows
    without one first, rows of one doc_id by leaf digest; a missing language is a tree of its own. Repeated
    rows are leaves of their own with the same digest. `folded_root` starts from the leaf of a text whose
    A-Z are lower-cased where 3 divides the crc32 of the decimal doc_id, else from the leaf itself; rows
    without a doc_id are never changed. A language of one row has its leaf as subroot, one language alone has
    its subroot as root, and the proof of a lone row is the hash of nothing. No rows give no rows. Other columns
    are left out.
    """
    tampered = F.when(tampered_with(F.col("doc_id")), leaf_of(F.translate("text", UPPER, LOWER)))
    # Trees sort as their languages do, null first: a mark in front keeps "" apart from null.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.col("n_chars").cast("bigint").alias("n_chars"), "text")
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf_of(F.col("text")).alias("digest"), tampered.alias("tampered"))
    # Written first: the sort looks at its input twice, and the texts are to be hashed once.
    forest = Forest(ranked(written(leaves, "leaves"), ["doc_id", "digest"]))
    subroots = written(forest.roots(), "subroots")
    # The subroots are leaves of one tree over all languages.
    whole = Forest(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]))
    tops = whole.roots().select("tree", F.col("digest").alias("root"), F.array().cast(f"array<{_STEP}>").alias("path"))
    tops = whole.attached(written(tops, "root"))
    tops = written(tops.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "tops")
    rows = forest.attached(tops).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """
    list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, c: list_reduce(
            list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda r, _: xor(r >> 1, 3988292384 * (r & 1))))
"""
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
_NODES = """
    {name} AS (
        SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
        FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 8, n
    ),
"""
_STEPS = """
    SELECT l.key, b.level + {shift} AS level,
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < b.idx), '') AS before,
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > b.idx), '') AS after
    FROM {leaves} l JOIN {nodes} b ON b.tree = l.tree AND b.idx = l.idx // (8 ** b.level)::BIGINT AND b.n > 1
    JOIN {nodes} s ON s.tree = b.tree AND s.level = b.level AND s.idx // 8 = b.idx // 8
    GROUP BY l.key, b.level, b.idx
"""
# Level by level, as the definition says; the same result by another way.
SQL = f"""
WITH RECURSIVE raw AS (
    SELECT coalesce('=' || lang, '') AS tree, doc_id, sha256({_LEAF}) AS leaf,
           CASE WHEN xor({_CRC}, 4294967295) % 3 = 0
                THEN sha256({_LEAF.replace("text::", f"translate(text, '{UPPER}', '{LOWER}')::")}) END AS tampered
    FROM documents
), leaves AS (
    SELECT *, leaf AS digest, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS key,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY tree) AS n
    FROM raw
), {_NODES.format(name="nodes", leaves="leaves")}
subroots AS (
    SELECT '' AS tree, tree AS key, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), {_NODES.format(name="tops", leaves="subroots")}
top_steps AS ({_STEPS.format(shift="1000", leaves="subroots", nodes="tops")}),
steps AS (
    {_STEPS.format(shift="0", leaves="leaves", nodes="nodes")}
    UNION ALL SELECT l.key, t.level, t.before, t.after FROM leaves l JOIN top_steps t ON t.key = l.tree
), numbered AS (
    SELECT key, row_number() OVER (PARTITION BY key ORDER BY level) AS step, before, after FROM steps
), folds AS (
    SELECT key, 0::BIGINT AS step, coalesce(tampered, leaf) AS digest FROM leaves
    UNION ALL
    SELECT f.key, f.step + 1, sha256(p.before || f.digest || p.after)
    FROM folds f JOIN numbered p ON p.key = f.key AND p.step = f.step + 1
), proofs AS (
    SELECT key, string_agg(before || after, '' ORDER BY step) AS proof FROM numbered GROUP BY key
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l
JOIN subroots s ON s.key = l.tree
JOIN (SELECT digest FROM tops WHERE n = 1) r ON true
LEFT JOIN proofs p ON p.key = l.key
JOIN (SELECT key, digest, row_number() OVER (PARTITION BY key ORDER BY step DESC) AS last FROM folds) f ON f.key = l.key AND f.last = 1
"""

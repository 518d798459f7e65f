"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are summed up by the set of sources they belong to (their pattern). Token capacity flows from
patterns to the quotas of their sources; a pattern's first pass over its documents is free and each
further pass costs more, so nothing is repeated while a quota can be met with fresh text. The graph has
one node per pattern and per source: its size follows the catalogue of sources, not the documents.
"""

from __future__ import annotations

from collections import deque
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro.llm.words import free_name, text_or_empty
from murmuro.runtime import fixed_table, is_small, written

# Rows of a pattern that are put in order together.
BUCKET_ROWS = 2_000
# A rest of fewer mean documents than this is filled with the largest that fit, a greater one in seeded order.
FEW = 10
# The seeded order of a pattern's documents.
ORDER = ["share", "place", "size", "row"]
# White space as the sizes define it: blank and the five control characters from tab to carriage return.
SIZE_WORD = r"[^\x20\x09-\x0D]+"


def source_name(column: str) -> Column:
    """A source as text that sorts by code point with missing sources last."""
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(column)))


def targets(sizes: dict[str, int], weights: dict[str, float], amount: float, most: float) -> dict[str, float]:
    """Share `amount` by weight; a share stops at `most` times the source's size and the excess is reshared."""
    out = {s: 0.0 for s in sizes}
    open_ = {s for s in sizes if weights[s] > 0}
    left = amount
    while open_:
        total = sum(weights[s] for s in sorted(open_))
        share = {s: left * weights[s] / total for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        if not full:
            return out | share
        for s in sorted(full):
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def route(
    capacity: dict[tuple[str, ...], int], quota: dict[str, int], passes: int
) -> dict[tuple[str, ...], dict[str, int]]:
    """Tokens that each pattern gives to each of its sources: a maximum flow of least cost.

    The marginal cost of a pass is the same for every pattern and grows with the pass, so the cheapest
    flow comes from opening the passes one after the other and augmenting along shortest paths each time.
    """
    patterns, sources = sorted(capacity), sorted(quota)
    start, end = 0, 1
    node = {("p", p): i + 2 for i, p in enumerate(patterns)}
    node |= {("s", s): len(node) + 2 + i for i, s in enumerate(sources)}
    edges: list[list[int]] = []  # [to, residual capacity]; edge i ^ 1 is the reverse of edge i
    out: list[list[int]] = [[] for _ in range(len(node) + 2)]

    def edge(a: int, b: int, c: int) -> int:
        out[a].append(len(edges))
        out[b].append(len(edges) + 1)
        edges.extend([[b, c], [a, 0]])
        return len(edges) - 2

    feed = {p: edge(start, node["p", p], 0) for p in patterns}
    links = {(p, s): edge(node["p", p], node["s", s], sum(quota.values())) for p in patterns for s in p if s in quota}
    for s in sources:
        edge(node["s", s], end, quota[s])

    for _ in range(passes):
        for p in patterns:
            edges[feed[p]][1] += capacity[p]
        while True:
            depth = {start: 0}
            queue = deque([start])
            while queue:
                a = queue.popleft()
                for e in out[a]:
                    b, c = edges[e]
                    if c > 0 and b not in depth:
                        depth[b] = depth[a] + 1
                        queue.append(b)
            if end not in depth:
                break
            at = [0] * len(out)
            while True:  # blocking flow, with a path kept by hand instead of recursion
                path, a = [], start
                while a != end:
                    while at[a] < len(out[a]):
                        e = out[a][at[a]]
                        b, c = edges[e]
                        if c > 0 and depth.get(b) == depth[a] + 1:
                            path.append(e)
                            a = b
                            break
                        at[a] += 1
                    else:
                        if not path:
                            break
                        a = edges[path.pop() ^ 1][0]
                        at[a] += 1
                if a != end:
                    break
                flow = min(edges[e][1] for e in path)
                for e in path:
                    edges[e][1] -= flow
                    edges[e ^ 1][1] += flow
    given: dict[tuple[str, ...], dict[str, int]] = {p: {} for p in patterns}
    for (p, s), e in links.items():
        if edges[e ^ 1][1]:
            given[p][s] = edges[e ^ 1][1]
    return given


def running(rows: DataFrame, size: Column) -> DataFrame:
    """`rows` with `at`: the sum of `size` over the rows of the pattern before this one in seeded order.

    Rows are (pattern, bucket, share, place, size, row, ...); a bucket row stands for about BUCKET_ROWS documents.
    """
    totals = rows.groupBy("pattern", "bucket").agg(F.sum(size).alias("total"))
    earlier = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("pattern", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("pattern", "bucket").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(before, ["pattern", "bucket"])
    return placed.withColumn("at", F.col("before") + F.coalesce(F.sum(size).over(inside), F.lit(0))).drop("before")


def fillers(open_: DataFrame, left: dict[str, int]) -> DataFrame:
    """(row, from_end): documents that fill what is left of each pattern's quota, and where, counted back from its end.

    `open_`: the documents (pattern, bucket, share, place, size, row) that may be taken. Those too large for the rest
    are put aside and the running sum goes on over the others, as long as the rest is worth FEW of them. Then
    the largest that fit come first, by the number of documents of each size, until none fits, and one
    more document where that comes nearer to the quota than leaving the rest open.
    """
    spark = open_.sparkSession
    kind = "pattern string,gap bigint"
    gaps = lambda of: F.broadcast(fixed_table(spark, [(p, left[p]) for p in sorted(of)], kind))
    parts = []
    while True:
        left = {p: n for p, n in left.items() if n > 0}
        fit = open_.join(gaps(left), "pattern").where("size <= gap")
        stats = fit.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).collect()
        again = {r.pattern for r in stats if left[r.pattern] * r.n > FEW * r.total}
        if not again:
            break
        fits = F.coalesce(F.col("size") <= F.col("gap"), F.lit(False))
        tried = running(open_.join(gaps(again), "pattern", "left"), F.when(fits, F.col("size")).otherwise(0))
        tried = written(tried.withColumn("hit", fits & (F.col("at") + F.col("size") <= F.col("gap"))), "tried")
        hits = tried.where("hit")
        parts.append(hits.select("row", (F.col("gap") - F.col("at")).alias("from_end")))
        for r in hits.groupBy("pattern").agg(F.sum("size").alias("size")).collect():
            left[r.pattern] -= r.size
        open_ = tried.where("NOT hit").drop("gap", "at", "hit")

    # One row per size up to the rest of a pattern, however many documents there are.
    sizes = fit.groupBy("pattern", "gap", "size").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern", "gap")
    sizes = sizes.agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("c"))
    fill = F.aggregate(
        "c",
        F.struct(F.col("gap").alias("left"), F.array().cast("array<struct<size: bigint, take: bigint>>").alias("takes")),
        lambda acc, x: F.when(
            x["size"] <= acc["left"],
            F.struct(
                (acc["left"] - x["size"] * F.least(x["n"], F.floor(acc["left"] / x["size"]))).alias("left"),
                F.concat(
                    acc["takes"],
                    F.array(F.struct(x["size"].alias("size"), F.least(x["n"], F.floor(acc["left"] / x["size"])).alias("take"))),
                ).alias("takes"),
            ),
        ).otherwise(acc),
    )
    takes = []
    rest = dict(left)
    for r in sizes.select("pattern", fill.alias("fill")).collect():
        rest[r.pattern] = r.fill.left
        takes += [(r.pattern, t.size, t.take) for t in r.fill.takes]
    takes = F.broadcast(fixed_table(spark, takes, "pattern string,size bigint,take bigint"))
    same = open_.join(takes, ["pattern", "size"])
    counts = same.groupBy("pattern", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("pattern", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("pattern", "size", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("pattern", "size", "bucket").orderBy(*ORDER))
    same = same.join(counts, ["pattern", "size", "bucket"]).withColumn("nth", F.col("before") + nth)
    picked = written(same.where("nth <= take").join(gaps(left), "pattern").select("row", F.col("gap").alias("from_end")), "picked")
    parts.append(picked)

    # At most as many rows as the rest, that is less than FEW mean documents, has words.
    others = open_.join(F.broadcast(picked.select("row")), "row", "left_anti")
    ends = F.broadcast(fixed_table(spark, sorted(rest.items()), kind))
    over = others.join(ends, "pattern").where((F.col("size") > F.col("gap")) & (F.col("size") < 2 * F.col("gap")))
    over = over.groupBy("pattern", "gap").agg(F.min(F.struct("size", "place", "row")).alias("x"))
    parts.append(over.select(F.col("x.row").alias("row"), F.col("gap").alias("from_end")))
    return reduce(DataFrame.unionByName, parts)


def mix(
    docs: DataFrame,
    weights: list[float],
    amount: float,
    passes: int = 2,
    sources: Column | None = None,
    seed: int = 20,
    row: str | None = None,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, routed): how often each document is in the mix.

    `sources`: array of what `source_name` makes (default: of its `source`); a document counts to the size of each.
    `weights` repeat over the sources in code point order, missing source last. `amount`: the mix, as a share
    of all sizes. `passes`: the most copies of a document. `routed` names the source that each copy is for;
    `source_size` and `target` are those of the document's first source; `row` names a key to carry along.

    Documents are whole: a pattern's documents stand in a seeded order that depends on doc_id and text
    only, those before the cut get one copy more, and all the next ones are gone through to fill what is left. A
    missing text has size 0, and documents of size 0 take part in whole passes. Repeated rows count each. No rows give
    no rows.
    """
    spark = docs.sparkSession
    chosen = sources if sources is not None else F.array(source_name("source"))
    name = free_name(docs.columns, "pattern")
    base = docs.withColumn(name, F.array_sort(F.array_distinct(chosen)))
    rows = written(
        base.select(
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col(name).alias("sources"),
            F.to_json(name).alias("pattern"),
            F.regexp_count(text_or_empty(), F.lit(SIZE_WORD)).cast("bigint").alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", text_or_empty()).alias("place"),
        ),
        "sizes",
    )
    stats = rows.groupBy("pattern", "sources").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    capacity = {tuple(r.sources): r.size for r in stats}
    of_source: dict[str, int] = {}
    for p, n in capacity.items():
        for s in p:
            of_source[s] = of_source.get(s, 0) + n
    names = sorted(of_source)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = targets(of_source, weight, amount * sum(capacity.values()), passes)
    given = route(capacity, {s: int(target[s]) for s in names}, passes)

    plan, segments = [], []
    for r in stats:
        p = tuple(r.sources)
        want, first = sum(given[p].values()), p[0] if p else None
        whole, rest = divmod(want, r.size) if r.size else (0, 0)
        plan.append(
            (r.pattern, r.size, whole, rest, -(-r.n // BUCKET_ROWS), of_source.get(first, 0), target.get(first, 0.0))
        )
        at = 0
        for s in sorted(given[p]):
            at += given[p][s]
            segments.append((r.pattern, at, s[1:] if s[0] == "0" else None))
    plan = fixed_table(
        spark,
        plan,
        "pattern string,capacity bigint,whole bigint,rest bigint,buckets bigint,source_size bigint,target double",
    )
    ends = fixed_table(spark, segments, "pattern string,upto bigint,name string").groupBy("pattern")
    ends = ends.agg(F.array_sort(F.collect_list(F.struct("upto", "name"))).alias("ends"))
    plan = plan.join(ends, "pattern", "left")

    # The plan has one row per pattern, as large as the graph that was just solved here.
    rows = rows.drop("sources").join(F.broadcast(plan), "pattern")
    share = (F.shiftrightunsigned("place", 11)).cast("double") / float(1 << 53)
    rows = written(rows.withColumn("bucket", F.floor(share * F.col("buckets"))), "ordered")
    placed = running(rows.withColumn("share", share), F.col("size"))
    placed = written(placed.drop("buckets"), "placed")

    fits = (F.col("at") + F.col("size") <= F.col("rest")) & (F.col("rest") > 0)
    reached = F.coalesce(F.max(F.when(fits, F.col("at") + F.col("size"))), F.lit(0))
    left = placed.where("rest > 0").groupBy("pattern", "rest").agg((F.col("rest") - reached).alias("left")).collect()
    open_ = placed.where(~fits & (F.col("rest") > 0) & (F.col("size") > 0)).select("pattern", "bucket", "share", "place", "size", "row")
    extra = written(fillers(open_, {r.pattern: r.left for r in left}), "fillers")
    out = placed.join(F.broadcast(extra) if is_small(extra) else extra, "row", "left")
    extra_at = F.col("rest") - F.col("from_end")
    out = out.withColumn("copies", F.col("whole") + F.when(fits | extra_at.isNotNull(), 1).otherwise(0))
    # A filler's last copy stands where it fills the quota.
    at = lambda k: F.when(k >= F.col("whole"), F.coalesce(extra_at, F.col("at"))).otherwise(F.col("at"))
    middle = lambda k: k * F.col("capacity") + at(k) + F.col("size") / 2
    routed = F.transform(
        F.sequence(F.lit(1), F.col("copies")),
        lambda k: F.coalesce(
            F.get(F.filter("ends", lambda e: e["upto"] > middle(k - 1)), F.lit(0))["name"],
            F.try_element_at("ends", F.lit(-1))["name"],
        ),
    )
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        F.when(F.col("copies") > 0, routed).otherwise(F.array().cast("array<string>")).alias("routed"),
        "row",
    )


def mixed_documents(docs: DataFrame, weights: list[float], amount: float, passes: int = 2) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it."""
    key = free_name(docs.columns, "row")
    stored = written(docs.withColumn(key, F.monotonically_increasing_id()), "docs")
    chosen = mix(stored, weights, amount, passes, row=key).where("copies > 0").select(F.col("row").alias(key), "copies")
    chosen = written(chosen, "chosen")
    name = free_name([*docs.columns, key], "copies")
    copies = chosen.select(key, F.sequence(F.lit(1), F.col("copies")).alias(name))
    # The same plan at every size.
    joined = stored.join(copies.hint("merge"), key)
    return joined.withColumn(name, F.explode(name)).drop(key, name)

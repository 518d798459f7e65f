"""Batch retrieval: dense, lexical, hybrid, diverse, filtered, pooled, reranked.

Queries are a table, answered together. Hits are rows (query_id, rank, doc_id, …).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import text, vectors
from murmuro.runtime import is_small, lookup_join, n_rows, scalar, unnest, written

# Query vectors answered in one pass over the index; more queries take more passes.
QUERY_BLOCK = 2048


def ranked(hits: DataFrame, k: int | None, *order: Column, per: str = "query_id") -> DataFrame:
    """Rank hits per query from 1 and keep the first `k`.

    The rank limit is applied inside every task before the shuffle, so a query sends at
    most `k` rows per task.
    """
    w = Window.partitionBy(per).orderBy(*order)
    out = hits.withColumn("rank", F.row_number().over(w))
    return out if k is None else out.where(F.col("rank") <= k)


def filtered_index(index: DataFrame, filters: dict[str, object]) -> DataFrame:
    """Rows equal to every given metadata value; reaches the Parquet scan."""
    return reduce(lambda df, kv: df.where(F.col(kv[0]) == F.lit(kv[1])), filters.items(), index)


def _query_blocks(queries: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    """The query vectors in blocks of bounded size."""
    n = queries.count()
    blocks = -(-n // QUERY_BLOCK) if n else 0
    keyed = queries.select("query_id", "embedding", F.pmod(F.xxhash64("query_id"), F.lit(max(blocks, 1))).alias("_block"))
    for block in range(blocks):
        rows = keyed.where(F.col("_block") == block).collect()
        yield [r["query_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)


def semantic(queries: DataFrame, index: DataFrame, k: int = fixed.TOP_K, order_key: str = "doc_id") -> DataFrame:
    """(query_id, rank, doc_id, distance): exact nearest rows by squared Euclidean distance, ties by id.

    Each task multiplies its index rows with the block of queries in numpy and keeps only
    its own best `k` per query, so what is shuffled does not grow with the index rows.
    """
    rows = index.where(F.col("embedding").isNotNull()).select(F.col(order_key).cast("bigint").alias("doc_id"), "embedding")
    id_type = queries.schema["query_id"].dataType.simpleString()
    schema = f"query_id {id_type}, doc_id bigint, distance double"
    out = None
    for ids, matrix in _query_blocks(queries):
        part = rows.mapInArrow(_best_per_task(ids, matrix, k, id_type), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = index.sparkSession.createDataFrame([], schema)
    return ranked(out, k, F.asc("distance"), F.asc("doc_id")).select("query_id", "rank", "doc_id", "distance")


def _best_per_task(ids: list, matrix: np.ndarray, k: int, id_type: str):
    arrow_type = pa.string() if id_type == "string" else pa.int64() if id_type == "bigint" else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = (matrix * matrix).sum(axis=1)
        best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in ids]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            docs = batch.column(0).to_numpy()
            points = batch.column(1).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
            far = lengths[:, None] + (points * points).sum(axis=1)[None, :] - 2.0 * matrix @ points.T
            far = np.round(np.maximum(far, 0.0), 9)
            for q in range(len(ids)):
                have, have_docs = best[q]
                worst = have[-1] if len(have) == k else np.inf
                near = np.flatnonzero(far[q] <= worst)
                if len(near):
                    d = np.concatenate([have, far[q][near]])
                    i = np.concatenate([have_docs, docs[near]])
                    keep = np.lexsort((i, d))[:k]
                    best[q] = (d[keep], i[keep])
        sizes = [len(d) for d, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x, n in zip(ids, sizes) for _ in range(n)], type=arrow_type),
                pa.array(np.concatenate([i for _, i in best]) if ids else [], type=pa.int64()),
                pa.array(np.concatenate([d for d, _ in best]) if ids else [], type=pa.float64()),
            ],
            names=["query_id", "doc_id", "distance"],
        )

    return run


def with_columns_of(hits: DataFrame, index: DataFrame, *names: str, order_key: str = "doc_id") -> DataFrame:
    """Attach index columns to hits.

    Hits are written first, a few rows per query: they are then the side that travels, so the
    index is scanned for the wanted columns but not shuffled.
    """
    return lookup_join(index.select(F.col(order_key).alias("doc_id"), *names), written(hits, "hits"), "doc_id")


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true hits that were found."""
    marked = truth.select("query_id", "doc_id").join(
        found.select("query_id", "doc_id", F.lit(1.0).alias("hit")), ["query_id", "doc_id"], "left"
    )
    return marked.agg(n_rows("truth"), F.coalesce(F.avg(F.coalesce("hit", F.lit(0.0))), F.lit(0.0)).alias("recall"))


def diverse(
    queries: DataFrame,
    index: DataFrame,
    k: int = fixed.TOP_K,
    fetch: int = 20,
    balance: float = 0.5,
    order_key: str = "doc_id",
) -> DataFrame:
    """(query_id, rank, doc_id): greedy maximal marginal relevance among the nearest `fetch` rows."""
    near = with_columns_of(semantic(queries, index, fetch, order_key), index, "embedding", order_key=order_key)
    asked = queries.select("query_id", F.col("embedding").alias("query_vector"))
    rows = lookup_join(near, asked, "query_id")
    id_type = queries.schema["query_id"].dataType.simpleString()

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        points = np.array(group["embedding"].tolist(), dtype=np.float64)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        query = np.array(group["query_vector"].iloc[0], dtype=np.float64)
        to_query = points @ (query / np.linalg.norm(query))
        among = points @ points.T
        chosen: list[int] = []
        while len(chosen) < min(k, len(points)):
            closest = among[:, chosen].max(axis=1) if chosen else np.zeros(len(points))
            gain = to_query if not chosen else balance * to_query - (1 - balance) * closest
            gain = np.round(gain, 9)
            gain[chosen] = -np.inf
            chosen.append(int(gain.argmax()))
        picked = group.iloc[chosen]
        return pd.DataFrame(
            {"query_id": picked["query_id"], "rank": range(1, len(chosen) + 1), "doc_id": picked["doc_id"]}
        )

    return rows.groupBy("query_id").applyInPandas(choose, f"query_id {id_type}, rank int, doc_id bigint")


def _terms(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\S+"), 0)


def lexical(
    queries: DataFrame,
    docs: DataFrame,
    k: int = fixed.TOP_K,
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
    epsilon: float = fixed.BM25_EPSILON,
    order_key: str = "doc_id",
) -> DataFrame:
    """(query_id, rank, doc_id, score): BM25 over case-sensitive white-space tokens.

    The vocabulary with its document frequencies is written once. Query terms that may travel go to every task, and a
    document is scored where it lies. More of them, or documents that share an id, are joined: tokens that no query
    asks for are dropped before anything is grouped, and a token of a document is counted once however many ask for it.
    """
    toks = docs.select(F.col(order_key).alias("doc_id"), _terms(F.col("text")).alias("toks"))
    frequencies = written(
        unnest(toks, F.array_distinct("toks"), "term").groupBy("term").agg(n_rows("df")),
        "document-frequencies",
    )
    sizes = toks.agg(n_rows("n"), F.avg(F.greatest(F.coalesce(F.size("toks"), F.lit(0)), F.lit(0))).alias("mean_length")).first()
    n, mean_length = sizes["n"], sizes["mean_length"] or 1.0
    raw_idf = F.log(F.lit(float(n)) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    floor = scalar(frequencies.agg(F.avg(raw_idf) * epsilon))
    idf = F.when(raw_idf < 0, floor).otherwise(raw_idf)

    asked = unnest(queries, _terms(F.col("text")), "term", "query_id")
    asked = asked.groupBy("query_id", "term").agg(n_rows("times"))
    weighted = written(
        asked.join(frequencies, "term").select("query_id", "term", (idf * F.col("times")).alias("weight")), "query-terms"
    )
    if is_small(weighted) and docs.groupBy(order_key).agg(n_rows("n")).where("n > 1").isEmpty():
        scores = _scores_in_place(toks, weighted, k, k1, b, mean_length)
    else:
        scores = _grouped_scores(toks, weighted, k1, b, mean_length)
    return ranked(scores, k, F.desc("score"), F.asc("doc_id")).select("query_id", "rank", "doc_id", "score")


def _grouped_scores(toks: DataFrame, weighted: DataFrame, k1: float, b: float, mean_length: float) -> DataFrame:
    """(query_id, doc_id, score) of every document with a term of the query."""
    wanted = weighted.select("term").distinct()
    rows = unnest(toks, "toks", "term", "doc_id", F.size("toks").alias("length"))
    counted = (
        lookup_join(rows, wanted, "term", "left_semi", spread=["doc_id"])
        .groupBy("doc_id", "length", "term")
        .agg(n_rows("tf"))
    )
    damped = F.col("tf") + k1 * (1 - b + b * F.col("length") / mean_length)
    part = F.col("weight") * F.col("tf") * (k1 + 1) / damped
    return (
        lookup_join(counted, weighted, "term", spread=["doc_id"])
        .groupBy("query_id", "doc_id")
        .agg(F.round(F.sum(part), 6).alias("score"))
    )


# Documents scored at a time.
SCORED_DOCS = 256


def _scores_in_place(toks: DataFrame, weighted: DataFrame, k: int, k1: float, b: float, mean_length: float) -> DataFrame:
    """(query_id, doc_id, score) of every document that can be among the best `k` of a query; nothing is shuffled.

    A task leaves out documents that `k` others of its own beat by more than rounding can turn.
    """
    table = weighted.select("query_id", "term", "weight").orderBy("term", "query_id").toArrow().combine_chunks()
    known = toks.sparkSession.sparkContext.broadcast(table)
    schema = f"query_id {weighted.schema['query_id'].dataType.simpleString()}, doc_id {toks.schema['doc_id'].dataType.simpleString()}, score double"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = known.value["term"].combine_chunks().dictionary_encode()
        names = coded.dictionary
        # The rows of a term lie together, in the order of the names.
        per_term = np.bincount(coded.indices.to_numpy(), minlength=len(names))
        first = np.cumsum(per_term) - per_term
        weight = known.value["weight"].to_numpy()
        queries = known.value["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        asks = queries.indices.to_numpy().astype(np.int64)
        beaten = np.full(len(queries.dictionary), -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_DOCS):
                part = batch.slice(at, SCORED_DOCS)
                lists = part.column(1)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
                term = pc.fill_null(pc.index_in(lists.flatten(), names), -1).to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), sizes)[term >= 0]
                found, tf = np.unique(owner * max(len(names), 1) + term[term >= 0], return_counts=True)
                owner, term = np.divmod(found, max(len(names), 1))
                share = tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[owner] / mean_length))
                # One row per query that asks for the term.
                times = per_term[term]
                row = np.repeat(first[term] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                pairs, where = np.unique(asks[row] * part.num_rows + np.repeat(owner, times), return_inverse=True)
                score = np.bincount(where, weights=weight[row] * np.repeat(share, times), minlength=len(pairs))
                query, owner = np.divmod(pairs, part.num_rows)
                near = score >= beaten[query] - 2e-6
                query, owner, score = query[near], owner[near], score[near]
                order = np.lexsort((-score, query))
                starts = np.flatnonzero(np.diff(query, prepend=-1))
                long = np.diff(np.append(starts, len(query))) >= k
                last = order[starts[long] + k - 1]
                beaten[query[last]] = np.maximum(beaten[query[last]], score[last])
                near = score >= beaten[query] - 2e-6
                yield pa.RecordBatch.from_arrays(
                    [queries.dictionary.take(pa.array(query[near])), part.column(0).take(pa.array(owner[near])), pa.array(score[near])],
                    names=["query_id", "doc_id", "score"],
                )

    found = toks.select("doc_id", "toks").mapInArrow(scored, schema)
    return found.withColumn("score", F.round("score", 6))


def fused(lists: list[tuple[DataFrame, float]], constant: int = fixed.RANK_FUSION_CONSTANT) -> DataFrame:
    """(query_id, rank, doc_id, text, score): weighted reciprocal-rank fusion, one row per distinct text.

    `lists` are hit lists with text. The result is not cut.
    """
    parts = [
        hits.select("query_id", "doc_id", "text", (F.lit(weight) / (constant + F.col("rank"))).alias("part"))
        for hits, weight in lists
    ]
    pooled = reduce(DataFrame.unionByName, parts)
    scores = pooled.groupBy("query_id", "text").agg(
        F.min("doc_id").alias("doc_id"), F.round(F.sum("part"), 9).alias("score")
    )
    return ranked(scores, None, F.desc("score"), F.asc("doc_id")).select("query_id", "rank", "doc_id", "text", "score")


def hybrid(
    queries: DataFrame,
    index: DataFrame,
    docs: DataFrame,
    k: int = fixed.TOP_K,
    weights: tuple[float, float] = (0.5, 0.5),
) -> DataFrame:
    """Dense and lexical hits fused by rank. Queries carry both text and vector."""
    dense = with_columns_of(semantic(queries, index, k), docs, "text")
    words = with_columns_of(lexical(queries, docs, k), docs, "text")
    return fused([(dense, weights[0]), (words, weights[1])])


def filtered(queries: DataFrame, index: DataFrame, filters: dict[str, object], k: int = fixed.TOP_K) -> DataFrame:
    """Nearest rows among those matching the metadata."""
    return semantic(queries, filtered_index(index, filters), k)


def reranked(hits: DataFrame, scores: DataFrame, k: int = 5) -> DataFrame:
    """Reorder hits by a second-stage score table (query_id, doc_id, score), best `k` kept."""
    joined = hits.drop("rank", "score").join(scores, ["query_id", "doc_id"])
    return ranked(joined, k, F.desc("score"), F.asc("doc_id"))


def cosine_scores(hits: DataFrame, queries: DataFrame, index: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """(query_id, doc_id, score): exact cosine of each hit with its query, a second-stage score."""
    pairs = with_columns_of(hits.select("query_id", "doc_id").distinct(), index, "embedding", order_key=order_key)
    asked = queries.select("query_id", F.col("embedding").alias("query_vector"))
    score = vectors.cosine(F.col("embedding"), F.col("query_vector"))
    return lookup_join(pairs, asked, "query_id").select("query_id", "doc_id", F.round(score, 6).alias("score"))


def pooled(lists: DataFrame, per: str = "query_id") -> DataFrame:
    """Several hit lists per query (list_no, rank, text) as one, each text at its first place."""
    return lists.groupBy(per, "text").agg(F.min(F.struct("list_no", "rank", "doc_id")).alias("first")).select(
        per, "first.doc_id", "text", F.col("first.list_no").alias("list_no"), F.col("first.rank").alias("list_rank")
    )


def expanded(
    questions: DataFrame, expansions: DataFrame, index: DataFrame, docs: DataFrame, k: int = fixed.TOP_K
) -> DataFrame:
    """Hits of several expansion vectors per question, pooled.

    `expansions` is (query_id, no, embedding). With more than one the pool is reranked by
    cosine with the original question, else its first `k` rows stand.
    """
    asked = expansions.select(
        F.concat_ws("/", F.col("query_id").cast("string"), F.col("no").cast("string")).alias("query_id"), "embedding"
    )
    parts = F.split("query_id", "/")
    kind = questions.schema["query_id"].dataType
    lists = semantic(asked, index, k).select(
        parts[0].cast(kind).alias("query_id"), parts[1].cast("int").alias("list_no"), "rank", "doc_id"
    )
    pool = pooled(with_columns_of(lists, docs, "text"))
    several = expansions.groupBy("query_id").agg((F.count(F.lit(1)) > 1).alias("several"))
    scored = pool.join(cosine_scores(pool, questions, index), ["query_id", "doc_id"]).join(several, "query_id")
    order = [
        F.when(F.col("several"), -F.col("score")).asc_nulls_first(),
        F.when(~F.col("several"), F.col("list_no")).asc_nulls_first(),
        F.when(~F.col("several"), F.col("list_rank")).asc_nulls_first(),
        F.asc("doc_id"),
    ]
    return ranked(scored, k, *order).select("query_id", "rank", "doc_id", "text", "score")


def side_by_side(named: dict[str, DataFrame]) -> DataFrame:
    """Hit lists of several strategies as (strategy, query_id, rank, doc_id)."""
    return reduce(
        DataFrame.unionByName,
        [hits.select(F.lit(name).alias("strategy"), "query_id", "rank", "doc_id") for name, hits in named.items()],
    )


def overlap(compared: DataFrame) -> DataFrame:
    """Number of shared hits per pair of strategies, over all queries.

    One row per hit lists the strategies that found it; pairs form inside that short list.
    """
    found = compared.groupBy("query_id", "doc_id").agg(F.sort_array(F.collect_set("strategy")).alias("s"))
    pairs = found.select(F.explode("s").alias("first"), "s").select("first", F.explode("s").alias("second"))
    return pairs.groupBy("first", "second").agg(n_rows("shared"))


def rank_shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Where the reranked hits stood before."""
    return after.select("query_id", "doc_id", F.col("rank").alias("rank_after")).join(
        before.select("query_id", "doc_id", F.col("rank").alias("rank_before")), ["query_id", "doc_id"]
    ).withColumn("moved_up", F.col("rank_before") - F.col("rank_after"))


def context_blocks(hits: DataFrame) -> DataFrame:
    """(query_id, context): the hits of each query (at most its top k) as one numbered text."""
    line = text.context_line(F.col("rank"), F.col("sentiment"), F.col("likes"), F.col("text"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"])
    return hits.groupBy("query_id").agg(F.array_join(lines, "\n\n").alias("context"))


def comment_documents(df: DataFrame, order_key: str = "doc_id") -> DataFrame:
    """Comments as text plus a nine-field metadata struct, missing columns and values filled."""
    from murmuro.sources.bind import column_or

    blank = F.lit("")

    def lists(name: str) -> Column:
        if name not in df.columns:
            return blank
        return text.joined(F.col(name)) if dict(df.dtypes)[name].startswith("array") else F.coalesce(F.col(name), blank)

    meta = F.struct(
        F.coalesce(column_or(df, "comment_id", blank, "string"), blank).alias("comment_id"),
        F.coalesce(column_or(df, "video_id", blank, "string"), blank).alias("video_id"),
        F.coalesce(column_or(df, "author", blank, "string"), blank).alias("author"),
        F.coalesce(column_or(df, "likes", F.lit(0), "bigint"), F.lit(0)).alias("likes"),
        F.coalesce(column_or(df, "published_at", blank, "string"), blank).alias("published_at"),
        F.coalesce(column_or(df, "sentiment", F.lit("unknown"), "string"), F.lit("unknown")).alias("sentiment"),
        F.coalesce(column_or(df, "topic", F.lit(-1), "int"), F.lit(-1)).alias("topic"),
        lists("entities").alias("entities"),
        lists("keywords").alias("keywords"),
    )
    return df.select(order_key, "text", meta.alias("meta"))

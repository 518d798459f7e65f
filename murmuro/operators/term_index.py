"""An inverted index of texts in Parquet, searched with score bounds per block of documents.

Documents are cut into shards as they are read, so building shuffles nothing. A stored row holds one term of one
shard: the places of its documents, how often each has the term, and per block of BLOCK documents the largest count
and the shortest length, which bound what the term can add to any score in the block. A search sends to every shard
the rows of the asked terms alone. There, per query, the terms' bounds are added up block by block, and blocks are
scored from the highest bound downwards until no other can reach the k-th best score. A task sends on k rows a query.
Scores, ranks and ties are those of `retrieval.lexical`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.operators.retrieval import ranked
from murmuro.runtime import lookup_join, n_rows, scalar, unnest, written

# Documents of a shard, tokens at about which it ends all the same, and documents of a block.
SHARD, SHARD_TOKENS, BLOCK = 16_384, 4 << 20, 16
# Blocks scored together; the next lot is larger.
LOT = 32
# Entries of term and document that are made into rows at a time.
ENTRIES = 1 << 18

_TOKEN = re.compile(r"[^ \t\n\x0b\f\r]+")
_SCHEMA = (
    "shard string, term string, n bigint, places array<int>, counts array<int>, "
    "blocks array<int>, most array<int>, shortest array<int>, doc_ids array<bigint>, lengths array<int>"
)


class _Shard:
    """Documents on their way into a shard: four bytes a token, every distinct term held once."""

    def __init__(self) -> None:
        self.doc_ids: list = []
        self.codes: list[np.ndarray] = []
        self.numbers: dict[str, int] = {}
        self.size = 0

    def add(self, doc_id: int | None, tokens: list[str]) -> None:
        numbers = self.numbers
        self.doc_ids.append(doc_id)
        self.codes.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def rows(self, shard: str, entries: int = ENTRIES) -> Iterator[dict[str, list]]:
        """The rows of the shard, terms in order, so many entries of term and document at a time; the first row (no
        term) has the documents and their lengths."""
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        lengths = np.fromiter(map(len, self.codes), np.int64, len(self.codes))
        # Documents of like length lie together, which keeps the bounds of a block near what its documents reach.
        order = np.argsort(lengths, kind="stable")
        doc_ids, lengths, n = [self.doc_ids[i] for i in order], lengths[order], max(len(order), 1)
        # Terms are numbered in their order, so entries lie in the order of rows.
        terms = sorted(self.numbers)
        ranks = np.empty(len(terms), np.int64)
        ranks[np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms))] = np.arange(len(terms))
        pairs = np.concatenate([np.empty(0, np.int64), *(ranks[self.codes[i]] * n + place for place, i in enumerate(order))])
        self.codes, self.numbers = [], {}
        pairs.sort()
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        counts = np.diff(first, append=len(pairs)).astype(np.int32)
        pairs = pairs[first]
        starts = np.searchsorted(pairs, np.arange(len(terms) + 1) * n)
        yield {c: [x] for c, x in zip(names, (shard, None, len(doc_ids), None, None, None, None, None, doc_ids, lengths), strict=True)}
        at = 0
        while at < len(terms):
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + entries, side="right")) - 1)
            part = slice(starts[at], starts[end])
            term, place, own = pairs[part] // n, (pairs[part] % n).astype(np.int32), counts[part]
            # A run is one term in one block.
            run = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(place // BLOCK, prepend=-1))
            most, shortest = np.maximum.reduceat(own, run), np.minimum.reduceat(lengths[place], run)
            cuts = starts[at : end + 1] - starts[at]
            runs = np.searchsorted(run, cuts)
            out: dict[str, list] = {c: [] for c in names}
            for i in range(end - at):
                a, b, s, e = cuts[i], cuts[i + 1], runs[i], runs[i + 1]
                row = (shard, terms[at + i], b - a, place[a:b], own[a:b], place[run[s:e]] // BLOCK, most[s:e], shortest[s:e], None, None)
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            yield out
            at = end


def shard_rows(shard: str, doc_ids: list, tokens: list[list[str]]) -> dict[str, list]:
    """All rows of one shard at once."""
    held = _Shard()
    for doc_id, words in zip(doc_ids, tokens, strict=True):
        held.add(doc_id, words)
    parts = list(held.rows(shard))
    return {c: [x for part in parts for x in part[c]] for c in parts[0]}


class TermIndex:
    """The index stored in a folder."""

    def __init__(self, spark: SparkSession, path: str, k1: float = fixed.BM25_K1, b: float = fixed.BM25_B, epsilon: float = fixed.BM25_EPSILON) -> None:
        self.spark, self.path, self.k1, self.b, self.epsilon = spark, path, k1, b, epsilon

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    @classmethod
    def build(cls, docs: DataFrame, path: str, order_key: str = "doc_id") -> TermIndex:
        """Index (order key, text) anew. Missing texts are empty documents."""
        index = cls(docs.sparkSession, path)
        index._write(docs, order_key, "overwrite")
        return index

    def append(self, docs: DataFrame, order_key: str = "doc_id") -> None:
        self._write(docs, order_key, "append")

    def _write(self, docs: DataFrame, order_key: str, mode: str) -> None:
        load = uuid.uuid4().hex
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
        types = [kinds[c.split()[1]] for c in _SCHEMA.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task, number = TaskContext.get().partitionId(), 0
            shard = _Shard()

            def rows() -> Iterator[pa.RecordBatch]:
                for columns in shard.rows(f"{load}-{task}-{number}"):
                    yield pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in zip(names, types, strict=True)], names)

            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                    shard.add(doc_id.as_py(), _TOKEN.findall(text.as_py() or ""))
                    if len(shard.doc_ids) >= SHARD or shard.size >= SHARD_TOKENS:
                        yield from rows()
                        number, shard = number + 1, _Shard()
            if shard.doc_ids:
                yield from rows()

        rows = docs.select(F.col(order_key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows.mapInArrow(run, _SCHEMA).write.mode(mode).parquet(self.path)

    def weights(self, queries: DataFrame) -> DataFrame:
        """(query_id, term, weight): the inverse document frequency of each term of a query, times its uses."""
        frequencies = self.rows.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
        frequencies = written(frequencies, "document-frequencies")
        n = scalar(self.rows.where("term IS NULL").agg(F.sum("n").cast("double")))
        frequencies = frequencies.withColumn("raw", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
        floor = scalar(frequencies.agg(F.avg("raw") * self.epsilon))
        asked = unnest(queries, F.regexp_extract_all("text", F.lit(r"\S+"), 0), "term", "query_id")
        asked = asked.groupBy("query_id", "term").agg(n_rows("times"))
        idf = F.when(F.col("raw") < 0, floor).otherwise(F.col("raw"))
        return asked.join(frequencies, "term").select("query_id", "term", (idf * F.col("times")).alias("weight"))

    def _found(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, doc_id, score, blocks, scored): the best rows of each task, and per query and shard a row without
        a doc_id that tells how many blocks hold its terms and how many of them were scored."""
        weights = written(self.weights(queries.select("query_id", "text")), "query-terms")
        # One row per asked term, with the queries that ask for it: the text index sends each of its rows once.
        asked = weights.groupBy("term").agg(F.collect_list(F.struct("query_id", "weight")).alias("asked"))
        stored = self.rows
        hits = lookup_join(stored.where("term IS NOT NULL"), asked, "term", spread=["shard"])
        about = stored.where("term IS NULL").withColumn("asked", F.lit(None).cast(asked.schema["asked"].dataType))
        kept = ["shard", "term", "places", "counts", "blocks", "most", "shortest", "doc_ids", "lengths", "asked"]
        rows = hits.select(*kept).unionByName(about.select(*kept)).repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
        mean = stored.where("term IS NULL").select(F.explode("lengths").alias("x")).agg(F.avg("x")).first()[0] or 1.0
        k1, b = self.k1, self.b
        id_type = queries.schema["query_id"].dataType.simpleString()
        id_arrow = {"string": pa.string(), "bigint": pa.int64()}.get(id_type, pa.int32())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict = {}
            effort: list[tuple] = []
            for terms, doc_ids, lengths in _shards(batches):
                search_shard(terms, doc_ids, lengths, best, effort, k, k1, b, mean)
            out = [(q, int(d), float(s), None, None) for q, (docs, scores) in best.items() for d, s in zip(docs, scores, strict=True)]
            out += [(q, None, None, blocks, scored) for q, blocks, scored in effort]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [id_arrow, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "doc_id", "score", "blocks", "scored"]
            )

        return rows.mapInArrow(run, f"query_id {id_type}, doc_id bigint, score double, blocks bigint, scored bigint")

    def search(self, queries: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
        """(query_id, rank, doc_id, score) of the k best documents that share a token with the query."""
        hits = self._found(queries, k).where("doc_id IS NOT NULL").select("query_id", "doc_id", "score")
        return ranked(hits, k, F.desc("score"), F.asc("doc_id")).select("query_id", "rank", "doc_id", "score")

    def effort(self, queries: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
        """(query_id, blocks, scored): how many blocks hold a term of the query, and how many were scored."""
        told = self._found(queries, k).where("doc_id IS NULL")
        return told.groupBy("query_id").agg(F.sum("blocks").alias("blocks"), F.sum("scored").alias("scored"))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(terms, doc_ids, lengths) of each whole shard; a term is (places, counts, blocks, most, shortest, asked)."""
    at, terms, doc_ids, lengths = None, [], None, None
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names}
        for i, shard in enumerate(columns["shard"].to_pylist()):
            if shard != at:
                if terms:
                    yield terms, doc_ids, lengths
                at, terms = shard, []
            if columns["term"][i].as_py() is None:
                doc_ids, lengths = (columns[c][i].values.to_numpy(zero_copy_only=False) for c in ("doc_ids", "lengths"))
            else:
                lists = (columns[c][i].values.to_numpy() for c in ("places", "counts", "blocks", "most", "shortest"))
                terms.append((*lists, columns["asked"][i].as_py()))
    if terms:
        yield terms, doc_ids, lengths


def search_shard(
    terms: list, doc_ids: np.ndarray, lengths: np.ndarray, best: dict, effort: list, k: int, k1: float, b: float, mean: float
) -> None:
    """Bring `best` (query to its best doc_ids and scores so far) up to date with one shard.

    Only blocks whose bound reaches the k-th best score are scored. Documents without an id take no part.
    """

    def damped(counts: np.ndarray, length: np.ndarray) -> np.ndarray:
        return counts * (k1 + 1) / (counts + k1 * (1 - b + b * length / mean))

    n_blocks = -(-len(doc_ids) // BLOCK)
    parts = []
    of_query: dict = {}
    for number, (places, counts, blocks, most, shortest, asked) in enumerate(terms):
        # A term's places in a block lie next to each other.
        starts = np.searchsorted(places, np.arange(n_blocks + 1) * BLOCK)
        parts.append((places, damped(counts, lengths[places]), starts))
        limit = damped(most, shortest)
        for x in asked:
            of_query.setdefault(x["query_id"], []).append((number, x["weight"], blocks, limit))
    for query, own in of_query.items():
        bound, present = np.zeros(n_blocks), np.zeros(n_blocks, bool)
        for _, weight, blocks, limit in own:
            bound[blocks] += max(weight, 0.0) * limit
            present[blocks] = True
        order = np.flatnonzero(present)
        order = order[np.argsort(-bound[order], kind="stable")]
        docs, scores = best.get(query, (np.empty(0, np.int64), np.empty(0)))
        at, lot, scored = 0, LOT, 0
        while at < len(order):
            # Scores are rounded, so a bound a little below may still tie.
            worst = scores[-1] - 1e-5 if len(scores) >= k else -np.inf
            chosen = order[at : at + lot]
            chosen = chosen[bound[chosen] >= worst]
            if not len(chosen):
                break
            scored += len(chosen)
            total, hit = np.zeros(n_blocks * BLOCK), np.zeros(n_blocks * BLOCK, bool)
            for number, weight, _, _ in own:
                places, impact, starts = parts[number]
                picked = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in chosen])
                total[places[picked]] += weight * impact[picked]
                hit[places[picked]] = True
            found = np.flatnonzero(hit)
            docs = np.concatenate([docs, doc_ids[found]])
            scores = np.concatenate([scores, np.round(total[found], 6)])
            keep = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            at, lot = at + lot, lot * 2
        best[query] = (docs, scores)
        effort.append((query, len(order), scored))

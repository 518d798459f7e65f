"""I-Match fingerprints: hashes of a document's mid-frequency terms under randomised lexicon subsets.

Terms are kept when the share of documents that hold them lies in a band. A subset keeps each lexicon
term with probability 2^-level by a seeded hash; the hash of a document's distinct terms in the subset is
one position of its fingerprint. The levels follow the number of kept terms, from about one term of the document in a
subset to an eighth of one: a few edits leave many positions alone, and texts whose numbers of terms differ by up to
eight times still have a level in common.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.llm.words import WORD, mixed, pieces, text_or_empty, word_hash
from murmuro.operators.order import bucketed
from murmuro.runtime import written

# Share of documents that hold a term: the band of inverse document frequencies.
LEAST, MOST = 0.001, 0.1
# Levels of a fingerprint, and subsets for each of them.
LEVELS, SUBSETS = 4, 24
# Distinct terms that a task counts before it hands the counts on.
COUNTED = 400_000

_SEEDS = mixed(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def terms(text: str) -> set[str]:
    """Distinct lower-cased words."""
    out: set[str] = set()
    for piece in pieces(text.lower()):
        out.update(WORD.findall(piece))
    return out


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, df): documents that hold each term, over all documents. Counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "df"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                counts.update(terms(text.as_py()))
                if len(counts) > COUNTED:
                    yield emit()
        yield emit()

    partial = docs.select(text_or_empty().alias("text")).mapInArrow(count, "term string, df bigint")
    return partial.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """(term, df) of the terms inside the band, and in two documents at least.

    Its size has a bound that does not grow with the corpus: terms in a share `least` of all documents
    are at most the mean number of distinct terms per document divided by `least`.
    """
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    share = F.col("df") / n.scalar()
    return term_counts(docs).where((F.col("df") >= 2) & (share >= least) & (share <= most))


def fingerprint(kept: set[str], words: dict[str, int]) -> str:
    """`level:` and the hashes for that level and the following, each 8 hex digits or dashes where no term is kept.

    `words`: the lexicon with the terms' hashes. A text without a lexicon term uses all its terms, and one
    without any term has the fingerprint `empty`.
    """
    found = [words[t] for t in kept if t in words] or [word_hash(t) for t in kept]
    if not found:
        return "empty"
    ids = np.unique(np.asarray(found, np.uint64))  # sorted and distinct
    level = len(ids).bit_length() - 1
    draws = mixed(ids[:, None] ^ _SEEDS[None, :])
    marks = mixed(draws + np.uint64(1))
    out = []
    for bits in range(level, level + LEVELS):
        keep = draws < np.uint64((1 << (64 - bits)) - 1)
        sums = np.where(keep, marks, np.uint64(0)).sum(axis=0, dtype=np.uint64)
        out += [f"{h >> 32:08x}" if any_ else "--------" for h, any_ in zip(sums.tolist(), keep.any(axis=0), strict=True)]
    return f"{level}:" + "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal positions among those that hold a term in either, over the levels both fingerprints have."""
    if a == b:
        return 1.0
    if "empty" in (a, b):
        return 0.0
    (la, _, pa_), (lb, _, pb) = a.partition(":"), b.partition(":")
    shift = int(lb) - int(la)
    width = 8 * SUBSETS
    # From the higher of the two first levels to the lower of the two last ones.
    pa_, pb = pa_[max(shift, 0) * width :], pb[max(-shift, 0) * width :]
    common = min(len(pa_), len(pb))
    pa_, pb = pa_[:common], pb[:common]
    pairs = [(pa_[i : i + 8], pb[i : i + 8]) for i in range(0, len(pa_), 8)]
    pairs = [p for p in pairs if p != ("--------", "--------")]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, tail, doc_id, text) to be read per bucket in falling doc_id order, each followed by its next.

    Value ranges of doc_id become buckets. The first rows of the bucket that follows stand at a bucket's
    end once more, marked `tail`; after the last bucket comes the first one. So no task needs another
    task's rows, and the texts are shuffled once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    # A missing doc_id stands below all others.
    low = F.coalesce("doc_id", F.lit(-(1 << 63)))
    ranged = bucketed(docs.withColumn("place", low), "place").withColumn("bucket", -F.col("_bucket").cast("int"))
    ranged = ranged.select("bucket", "place", "doc_id", "text")
    # One row per bucket from here on: as many as there are shuffle partitions.
    first = {r.bucket: r.place for r in ranged.groupBy("bucket").agg(F.max("place").alias("place")).collect()}
    found = sorted(first)
    if not found:
        return ranged.select("bucket", F.lit(True).alias("tail"), "doc_id", "text")
    heads = ranged.where(F.col("place").isin(list(first.values())))
    heads = heads.groupBy("bucket", "place").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "doc_id")).alias("x"))
    heads = heads.where(
        F.concat_ws(":", "bucket", "place").isin([f"{b}:{p}" for b, p in first.items()])
    )
    before = {b: found[i - 1] for i, b in enumerate(found)}
    follows = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    tails = heads.select(follows[F.col("bucket")].alias("bucket"), F.lit(True).alias("tail"), "x.doc_id", "x.text")
    rows = ranged.select("bucket", F.lit(False).alias("tail"), "doc_id", "text").unionByName(tails)
    order = ["bucket", "tail", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    # Each bucket is a partition of its own.
    return rows.repartitionById(1 - found[0], -F.col("bucket")).sortWithinPartitions(*order)


def fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Per document its fingerprint, and how far it survives an edit.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of
    the next document in falling doc_id order, after the last the first. Rows of one doc_id follow each
    other by a hash of the text, those without a doc_id come last, a missing text is empty, repeated rows
    each give a row. Other columns are left out. No rows give no rows.
    """
    spark = docs.sparkSession
    chosen = written(lexicon(docs, least, most), "lexicon")
    # Bounded whatever the corpus, see `lexicon`.
    words = spark.sparkContext.broadcast({r.term: _hash(r.term) for r in chosen.select("term").collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = words.value, [c.split()[0] for c in FIELDS.split(", ")]
        last = None  # bucket, doc_id, text, fingerprint: waits for its next
        for batch in batches:
            out = []
            for bucket, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mark = fingerprint(terms(text), known)
                if last and last[0] == bucket:
                    out.append(_row(*last[1:], text, mark, known))
                last = None if tail else (bucket, doc_id, text, mark)
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return with_next(docs).mapInArrow(run, FIELDS)


FIELDS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _hash(term: str) -> int:
    return word_hash(term)


def _row(doc_id, text: str, mark: str, next_text: str, next_mark: str, known: dict[str, int]) -> tuple:
    n = len(text)
    edited = text[: n - n // 3] + next_text[: n // 3]
    changed = fingerprint(terms(edited), known)
    return (
        doc_id,
        n,
        hashlib.sha256(edited.encode()).hexdigest(),
        mark,
        changed,
        likeness(mark, changed),
        likeness(mark, next_mark),
    )

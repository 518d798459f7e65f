"""Cutting long texts into chunks, all inside the row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import text
from murmuro.operators.corpus_vectors import CorpusVectors
from murmuro.runtime import unnest


def recursive_chunks(
    df: DataFrame, size: int = fixed.CHUNK_SIZE, overlap: int = fixed.CHUNK_OVERLAP, order_key: str = "doc_id"
) -> DataFrame:
    """(order key, chunk_no, chunk) of at most `size` characters.

    Each cut falls on the last blank line that fits, else the last line break, else the
    last space, else anywhere. From the second chunk on, up to `overlap` characters from
    the end of the previous one (starting at a word) come first.
    """
    body = size - overlap
    cuts = [rf".{{1,{body}}}\z", rf".{{1,{body - 2}}}\n\n", rf".{{1,{body - 1}}}\n", rf".{{1,{body - 1}}} ", rf".{{1,{body}}}"]
    pieces = F.regexp_extract_all("text", F.lit("(?s)" + "|".join(cuts)), 0)

    def tail(piece: Column) -> Column:
        if overlap == 0:
            return F.lit("")
        end = F.right(F.concat(F.lit(" "), piece), F.lit(overlap + 1))
        return F.regexp_extract(end, rf"(?s)\s(\S.{{0,{overlap - 1}}})\z", 1)

    before = F.concat(F.array(F.lit("")), F.transform(F.col("pieces"), tail))
    chunks = F.zip_with(F.slice(before, 1, F.size("pieces")), F.col("pieces"), lambda b, p: F.trim(F.concat(b, p)))
    cut = df.select(order_key, pieces.alias("pieces"))
    return unnest(cut, F.filter(chunks, lambda c: c != ""), "chunk", order_key, pos="chunk_no")


def token_chunks(
    df: DataFrame,
    size: int = fixed.TOKEN_CHUNK_SIZE,
    overlap: int = fixed.TOKEN_CHUNK_OVERLAP,
    order_key: str = "doc_id",
) -> DataFrame:
    """(order key, chunk_no, chunk): windows of `size` white-space tokens, `overlap` shared by neighbours."""
    toks = df.select(order_key, F.regexp_extract_all("text", F.lit(r"\S+"), 0).alias("toks"))
    last = F.greatest(F.size("toks") - overlap - 1, F.lit(0))
    starts = F.when(F.size("toks") > 0, F.sequence(F.lit(0), last, F.lit(size - overlap)))
    return unnest(toks, starts, "start", order_key, "toks", pos="chunk_no").select(
        order_key, "chunk_no", F.array_join(F.slice("toks", F.col("start") + 1, size), " ").alias("chunk")
    )


def _percentile(values: Column, percent: int) -> Column:
    """Linearly interpolated percentile of an array."""
    ordered = F.sort_array(values)
    at = (F.size(values) - 1) * F.lit(percent / 100)
    low = F.try_element_at(ordered, (F.floor(at) + 1).cast("int"))
    high = F.try_element_at(ordered, F.least(F.floor(at) + 2, F.size(values)).cast("int"))
    return low + (high - low) * (at - F.floor(at))


def semantic_chunks(df: DataFrame, percent: int = fixed.BREAK_PERCENTILE, order_key: str = "doc_id") -> DataFrame:
    """(order key, chunk_no, chunk): sentences grouped until the next one is unusually far away.

    Distance is one minus the cosine of the two sentences' word sets; a break is a distance
    above the given percentile of the text's own distances.
    """
    bags = F.transform("sentences", lambda s: F.array_distinct(F.regexp_extract_all(F.lower(s), F.lit(r"[\p{L}\p{N}']+"), 0)))

    def distance(a, b):
        both = F.sqrt(F.size(a).cast("double") * F.size(b).cast("double"))
        return F.round(1 - F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), both), F.lit(0.0)), 9)

    n = F.greatest(F.size("bags") - 1, F.lit(0))
    steps = (
        df.select(order_key, text.sentences(F.col("text")).alias("sentences"))
        .select(order_key, "sentences", bags.alias("bags"))
        .select(
            order_key,
            "sentences",
            F.zip_with(F.slice("bags", 1, n), F.slice("bags", 2, n), distance).alias("distances"),
        )
        .withColumn("threshold", _percentile(F.col("distances"), percent))
        .withColumn("breaks", F.transform("distances", lambda d: d > F.col("threshold")))
    )
    first = F.slice("sentences", 1, 1)
    rest = F.zip_with(F.slice("sentences", 2, F.size("breaks")), F.col("breaks"), lambda s, b: F.struct(s.alias("s"), b.alias("b")))

    def join(done, x):
        longer = F.concat_ws(" ", F.try_element_at(done, F.lit(-1)), x["s"])
        return F.when(x["b"], F.concat(done, F.array(x["s"]))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        )

    grouped = steps.select(order_key, F.aggregate(rest, first, join).alias("chunks"))
    return unnest(grouped, "chunks", "chunk", order_key, pos="chunk_no")


def semantic_vector_chunks(df: DataFrame, model: CorpusVectors, percent: int = fixed.BREAK_PERCENTILE, order_key: str = "doc_id") -> DataFrame:
    """(order key, chunk_no, chunk): the same by the vectors of the sentences, learned from the corpus.

    Distance is one minus the cosine of two neighbouring sentences' vectors, 1 where one has no known word.
    Texts are worked off one after the other in time proportional to their length.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    key_type = df.schema[order_key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers, chunks = [], [], []
            for key, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for number, part in enumerate(grouped_sentences(parts or [], shared.value, percent)):
                    keys.append(key)
                    numbers.append(number)
                    chunks.append(part)
            columns = [pa.array(keys, batch.column(0).type), pa.array(numbers, pa.int32()), pa.array(chunks, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [order_key, "chunk_no", "chunk"])

    rows = df.select(order_key, text.sentences(F.col("text")).alias("sentences"))
    return rows.mapInArrow(run, f"{order_key} {key_type}, chunk_no int, chunk string")


def sentence_distances(sentences: list[str], model: CorpusVectors) -> np.ndarray:
    """One minus the cosine of every sentence's vector and the next one's."""
    out, before = np.ones(max(len(sentences) - 1, 0)), None
    for i, here in enumerate(model.of_each(sentences)):
        if i and here is not None and before is not None:
            out[i - 1] = round(1 - float(before @ here), 6)
        before = here
    return out


def grouped_sentences(sentences: list[str], model: CorpusVectors, percent: int) -> list[str]:
    """Sentences joined by blanks, cut where the distance to the next is above the percentile of all distances of the text."""
    distances = sentence_distances(sentences, model)
    if not len(distances):
        return sentences
    starts = [0, *(np.flatnonzero(distances > np.percentile(distances, percent)) + 1).tolist(), len(sentences)]
    return [" ".join(sentences[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def chunk(df: DataFrame, strategy: str, order_key: str = "doc_id") -> DataFrame:
    """Chunks by the named strategy."""
    strategies = {"recursive": recursive_chunks, "token": token_chunks, "semantic": semantic_chunks}
    if strategy not in strategies:
        raise ValueError("strategy must be 'recursive', 'token' or 'semantic'")
    return strategies[strategy](df, order_key=order_key)

"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Tokens of A and B are byte ranges of the same text. Every token points to the farthest-right token it overlaps:
an A token to the B token that holds its last byte, a B token to the A token that holds its last byte if that
ends later, else to itself. Doubling the pointers, for all tokens of a batch at once, brings every token to the
last one of its component, whose end is where both tokenizers cut. That token labels the group.

No token of A goes from a non-blank over a following blank or line break, nor from a letter to the stop behind it, and
where B's vocabulary shows the same, a text falls apart in front of every single one of them: equal stretches have
equal tokens, groups and links. Each distinct stretch of a chunk of documents is encoded and aligned once. A link is counted over the whole corpus by its pair of ids:
chunks add up their own pairs, Spark sums them and joins the sums back per chunk and pair, so what is shuffled
grows with the distinct pairs of chunks and no task holds more than a chunk.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.runtime import written

# Characters of text, at about which a chunk of documents ends. A longer document is a chunk of its own.
CHUNK = 2 << 20
# Distinct stretches that a worker remembers from chunk to chunk; beyond that it starts anew.
REMEMBERED = 300_000
# Stretches encoded at a time.
AT_ONCE = 20_000

_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

_SCHEMA = (
    "chunk bigint, row int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "items array<int>, sizes array<int>, pairs array<bigint>, uses array<bigint>"
)


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Encodes stretches with both tokenizers and aligns them; `a_file` is a byte-level one, `b_file` one of pieces."""

    def __init__(self, a_file: str, b_file: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        # The strings of special tokens inside a text are ordinary text.
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        of = _byte_level()
        a_bytes = {i: bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [_piece_bytes(p) for p in pieces]
        self.a_length = np.asarray([len(a_bytes.get(i, b"")) for i in range(max(a_bytes) + 1)], np.int64)
        self.b_length = np.asarray([len(p) for p in self.b_bytes], np.int64)
        self.names = [str(i) for i in range(max(len(self.a_length), len(self.b_length)))]
        self.blank, self.line = pieces.index("▁"), self.b.encode("\n")[-1:]
        # A stretch may begin wherever no piece goes over its beginning.
        cuts = [r"(?<=\S)(?= \S)"]
        if not any("\n" in p for p in pieces) and self.b.encode("\n") == [self.blank, *self.line]:
            cuts.append(r"(?<=\S)(?=\n\S)")
            if not any(re.search(r"[A-Za-z][.,;:!?]", p) for p in pieces):
                cuts.append(r"(?<=[A-Za-z])(?=[.,;:!?](?:[ \n]|\Z))")
        self.cut = re.compile("|".join(cuts))
        self.known: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.groups: list[str] = []
        # Per stretch: A tokens, B tokens, groups, one after the other; -1 where the bytes differ from the text's.
        self.counts = array("q")
        # The links of all stretches, and where those of each end.
        self.links, self.ends = array("q"), array("q", [0])

    def _pieces(self, stretches: list[str]) -> list[list[int]]:
        """B's ids of stretches of a text: it puts a blank in front, which only those that begin with one keep."""
        asked = [s[1:] if s[0] == " " else s if s[0] == "\n" else f"\n{s}" for s in stretches]
        out = self.b.encode(asked, num_threads=1)
        for i, s in enumerate(stretches):
            if s[0] != " ":
                out[i] = out[i][1 if s[0] == "\n" else 2 :]
        return out

    def _learn(self, stretches: list[str]) -> None:
        """Encode and align stretches that are not known yet, each with the blank it begins with."""
        a_ids = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        b_ids = self._pieces(stretches)
        spelled = self.b_bytes
        right = [b"".join([spelled[t] for t in ids]) == s.encode() for ids, s in zip(b_ids, stretches, strict=True)]
        good = [i for i, ok in enumerate(right) if ok]
        if len(good) < len(stretches):
            a_ids, b_ids = [a_ids[i] for i in good], [b_ids[i] for i in good]
        a_size, b_size = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a_ids, b_ids))
        a = np.fromiter(chain.from_iterable(a_ids), np.int64, a_size.sum())
        b = np.fromiter(chain.from_iterable(b_ids), np.int64, b_size.sum())
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        a_group, b_group, n_groups = aligned(a_end, b_end)
        # In a group the last A and the last B token end together: that pair is its link.
        a_last, b_last = (np.flatnonzero(np.diff(g, append=n_groups)) for g in (a_group, b_group))
        keys = (a[a_last] << 32) | b[b_last]
        lines = [f"{x}|{y}" for x, y in zip(self._joined(a, a_group), self._joined(b, b_group), strict=True)]
        ends = a_group[np.cumsum(a_size) - 1] + 1 if len(good) else np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends])[:-1]
        first = len(self.groups)
        for i, low, high in zip(good, starts.tolist(), ends.tolist(), strict=True):
            self.known[stretches[i]] = len(self.groups)
            self.groups.append(lines[low] if high == low + 1 else ";".join(lines[low:high]))
        self.counts.frombytes(np.stack([a_size, b_size, ends - starts], 1).astype(np.int64).tobytes())
        self.ends.frombytes((len(self.links) + ends).astype(np.int64).tobytes())
        self.links.frombytes(keys.tobytes())
        assert len(self.groups) - first == len(good)
        for i, ok in enumerate(right):
            if not ok:
                self.known[stretches[i]] = len(self.groups)
                self.groups.append("")
                self.counts.extend((-1, -1, -1))
                self.ends.append(len(self.links))

    def _joined(self, ids: np.ndarray, group: np.ndarray) -> list[str]:
        """The ids of each group, comma-separated."""
        words = list(map(self.names.__getitem__, ids.tolist()))
        starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        return [words[s] if e - s == 1 else ",".join(words[s:e]) for s, e in zip(starts, [*starts[1:], len(words)], strict=True)]

    def chunk(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(stretches of all texts one after the other, number of stretches of each).

        Numbers lead to what is remembered. A text without tokens, or whose bytes differ, has no stretches.
        """
        if len(self.known) > REMEMBERED:
            self._forget()
        cut = [self.cut.split(f" {t}") if t else [] for t in texts]
        known = self.known
        new = list(set(chain.from_iterable(cut)).difference(known))
        for at in range(0, len(new), AT_ONCE):
            self._learn(new[at : at + AT_ONCE])
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        found = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, sizes.sum())
        bad = np.frombuffer(self.counts, np.int64).reshape(-1, 3)[found, 0] < 0
        if bad.any():
            owner = np.repeat(np.arange(len(cut)), sizes)
            wrong = np.unique(owner[bad])
            found = found[~np.isin(owner, wrong)]
            sizes[wrong] = 0
        return found, sizes


def _piece_bytes(piece: str) -> bytes:
    byte = _BYTE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def aligned(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of each A token, group of each B token, number of groups), given the ends of two tilings of the same bytes."""
    n = len(a_end)
    # A first, then B. The token that holds the byte before an end is the first that ends there or later.
    over = np.searchsorted(b_end, a_end)
    back = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end)) + n
    jump = np.concatenate([over + n, np.where(a_end[back] > b_end, back, own) if n else own])
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    last, group = np.unique(jump, return_inverse=True)
    return group[:n], group[n:], len(last)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_file: str, b_file: str) -> Aligner:
    if (a_file, b_file) not in _ALIGNERS:
        _ALIGNERS[a_file, b_file] = Aligner(a_file, b_file)
    return _ALIGNERS[a_file, b_file]


def _chunk_batch(aligner: Aligner, chunk: int, doc_ids: list, texts: list[str | None]) -> pa.RecordBatch:
    """One row per document, and a row (-1) that describes the chunk: its stretches' links as places in its pairs."""
    found, sizes = aligner.chunk(texts)
    # Stretches are numbered anew inside the chunk.
    stretches, items, times = np.unique(found, return_inverse=True, return_counts=True)
    ends = np.frombuffer(aligner.ends, np.int64)
    n_links = ends[stretches + 1] - ends[stretches]
    at = np.repeat(ends[stretches + 1] - np.cumsum(n_links), n_links) + np.arange(n_links.sum())
    pairs, places = np.unique(np.frombuffer(aligner.links, np.int64)[at], return_inverse=True)
    uses = np.bincount(places, weights=np.repeat(times, n_links), minlength=len(pairs)).astype(np.int64)
    counts = np.frombuffer(aligner.counts, np.int64).reshape(-1, 3)[found]
    total = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(counts, axis=0)])
    last = np.cumsum(sizes)
    n_a, n_b, n_groups = (total[last] - total[last - sizes]).T
    groups, sha = aligner.groups, []
    mine = found.tolist()
    for n, e in zip(sizes.tolist(), last.tolist(), strict=True):
        sha.append(hashlib.sha256(";".join([groups[i] for i in mine[e - n : e]]).encode()).hexdigest() if n else "")
    n = len(texts)

    def of_documents(values: np.ndarray) -> pa.Array:
        return pa.array(np.append(values, 0), pa.int64(), mask=np.arange(n + 1) == n)

    def of_chunk(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        # The documents' lists are empty.
        return pa.ListArray.from_arrays(pa.array(np.append(np.zeros(n + 1), len(values)), pa.int32()), pa.array(values, kind))

    lists = pa.array(np.concatenate([[0], last, [len(items) + len(places)]]), pa.int32())
    columns = [
        pa.array(np.full(n + 1, chunk), pa.int64()),
        pa.array(np.append(np.arange(n), -1), pa.int32()),
        pa.array([*doc_ids, None], pa.int64()),
        *(of_documents(x) for x in (n_a, n_b, n_groups, n_groups)),
        pa.array([*sha, None], pa.string()),
        pa.ListArray.from_arrays(lists, pa.array(np.concatenate([items, places]), pa.int32())),
        of_chunk(n_links, pa.int32()),
        of_chunk(pairs, pa.int64()),
        of_chunk(uses, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCHEMA.split(", ")])


def aligned_chunks(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Documents with counts and stretches, chunk by chunk, and per chunk a row about its stretches and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_file, b_file)
        # Unique over the write: the task's number and the chunk's number in it.
        chunk = TaskContext.get().partitionId() << 32
        doc_ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
                if held >= CHUNK:
                    yield _chunk_batch(aligner, chunk, doc_ids, texts)
                    chunk, doc_ids, texts, held = chunk + 1, [], [], 0
        if texts:
            yield _chunk_batch(aligner, chunk, doc_ids, texts)

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, _SCHEMA)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best) of all links: how many have this pair of ids, and whether no pair of its B id has more."""
    pairs = chunks.where("row = -1").select(F.explode(F.arrays_zip("pairs", "uses")).alias("x"))
    counts = written(pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.uses").alias("n")).where("n > 0"), "pair_counts")
    piece = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row per piece of B's vocabulary at most, which bounds this table whatever the corpus.
    most = counts.groupBy(piece.alias("piece")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("piece", piece).join(F.broadcast(most), "piece")
    return counts.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A encodes a blank and the text, B the text, to which it adds the blank. Missing and empty texts, and texts whose
    tokens do not spell the same bytes (a text with U+2581, which B uses for blanks), have no tokens: zeros and ''.
    A group ends where an A and a B token end together, and the two are its link. `n_best`: links whose pair is the
    most frequent one of its B id over all documents, ties included. `count_sum`: the frequencies of its links' pairs
    added up. Rows without a doc_id and repeated rows each give a row. Other columns are left out. No rows give no rows.
    """
    chunks = written(aligned_chunks(docs, a_file, b_file), "chunks")
    counts = written(pair_counts(chunks), "counts")
    wanted = chunks.where("row = -1").select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    found = wanted.join(counts.hint("merge"), "pair").select("of_chunk", "place", "n", "best")
    rows = chunks.select("chunk", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "items", "sizes")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def summed(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        about = documents.filter(pc.equal(documents["row"], -1))
        documents = documents.filter(pc.not_equal(documents["row"], -1))
        places, sizes = (np.asarray(about[c][0].values, np.int64) for c in ("items", "sizes"))
        at = pairs["place"].to_numpy()
        size = int(max(at.max(initial=-1), places.max(initial=-1))) + 1
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        n[at], best[at] = pairs["n"].to_numpy(), pairs["best"].to_numpy()
        stretch = np.repeat(np.arange(len(sizes)), sizes)
        per_stretch = [_added(stretch, x[places], len(sizes)) for x in (n, best)]
        items = documents["items"].combine_chunks()
        lengths = np.diff(items.offsets.to_numpy())
        values = items.flatten().to_numpy()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        count_sum, n_best = (_added(owner, x[values], len(lengths)) for x in per_stretch)
        columns = [documents[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        columns += [pa.array(n_best), pa.array(count_sum), documents["groups_sha256"].combine_chunks()]
        return pa.table(columns, names=[c.split()[0] for c in schema.split(", ")])

    return rows.groupBy("chunk").cogroup(found.groupBy("of_chunk")).applyInArrow(summed, schema)


def _added(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values of each owner, in whole numbers; owners are ascending."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.searchsorted(owner, np.arange(n + 1))
    return total[ends[1:]] - total[ends[:-1]]

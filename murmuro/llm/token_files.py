"""Token ids as Parquet list columns, and the index that finds them again.

Rows (doc_id, start_in_file, n_tokens, ids) in ascending doc_id order over all files. The ids are
dictionary-encoded (a public vocabulary has far fewer entries than a row group has ids); doc_id, offset
and length are delta-encoded, as they grow slowly. Row groups and pages have set sizes, and the page
index that Parquet writes lets a reader fetch a document's pages, or the metadata columns alone.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuro.llm.words import remembering, text_or_empty
from murmuro.runtime import shared_folder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1_000
# Parts of words whose ids a worker remembers in each of two generations.
REMEMBERED = 200_000
# Bytes of text that are encoded together, and words that are looked up together.
TEXT_BYTES, WORDS_AT_ONCE = 16 << 20, 1 << 18

_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
# How the vocabulary's own rule cuts a word of Latin-1 characters before merging; each part is encoded by itself.
_PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_STOPS = ".,;:!?"
_LATIN_1 = re.compile(r"[\x21-\x7e\xa1-\xff]*")

SCHEMA = "doc_id bigint, start_in_file bigint, n_tokens bigint, ids array<int>"


class WordEncoder:
    """Encodes texts with a tokenizer file, each distinct word of a batch once.

    The vocabulary drops white space and never merges across it, so a text's ids are its words' ids in
    a row. Arrow splits the texts and numbers their distinct words, and takes the stop off a word of
    letters. Any other word of Latin-1 characters is cut by the vocabulary's own rule. Each part goes
    through the library, and so does a word that cannot be cut. What is remembered has two generations:
    when the newer is full it becomes the older, and parts in use move on.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, word: str) -> list[str] | None:
        """The parts of a word in lower case, or None when only the library can tell."""
        if word.isalpha():
            return [word.lower()] if word.isascii() or max(word) <= "ÿ" else None
        if word.isascii() and word.isprintable() or _LATIN_1.fullmatch(word):
            if not any(s in word for s in self.special):
                return _PARTS.findall(word.lower())
        return None

    def _learn(self, parts: set[str], whole: list[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        # A whole word is never also a part: it holds something that no part holds.
        for word in whole:
            if word not in known:
                known[word] = older[word] if word in older else self._raw(word)
        new = []
        for part in parts:
            if part not in known:
                if (ids := older.get(part)) is None:
                    new.append(part)
                else:
                    known[part] = ids
        # To ASCII parts the vocabulary's normaliser does nothing more, so they go to its merges at once.
        merge = self.tokenizer.model.tokenize
        ascii_parts = [p for p in new if p.isascii()]
        merged = [[t.id for t in merge(p)] for p in ascii_parts]
        ids = np.fromiter(chain.from_iterable(merged), "<u4").tobytes()
        ends = (4 * np.cumsum([0, *map(len, merged)])).tolist()
        for part, a, b in zip(ascii_parts, ends[:-1], ends[1:], strict=True):
            known[part] = ids[a:b]
        new = [p for p in new if not p.isascii()]
        for at in range(0, len(new), 1_000):
            some = new[at : at + 1_000]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, of = np.asarray(encoded.ids, "<u4").tobytes(), np.asarray(encoded.word_ids)
            ends = (4 * np.searchsorted(of, np.arange(1, len(some) + 1))).tolist()
            for part, a, b in zip(some, [0, *ends[:-1]], ends, strict=True):
                known[part] = ids[a:b]

    def _ids(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of distinct words, one after the other; `plain` ones are parts already."""
        if plain:
            self._learn(set(words), [])
            out = list(map(self.known.__getitem__, words))
        else:
            cut = [self._cut(w) for w in words]
            whole = [w for w, parts in zip(words, cut, strict=True) if parts is None]
            self._learn({p for parts in cut if parts is not None for p in parts}, whole)
            known = self.known
            out = [known[w] if parts is None else b"".join([known[p] for p in parts]) for w, parts in zip(words, cut, strict=True)]
        return np.frombuffer(b"".join(out), "<i4"), np.fromiter(map(len, out), np.int64, len(out)) // 4

    def _table(self, words: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """`_ids` of an Arrow array, of which so many at a time become Python strings."""
        found = [(np.empty(0, "<i4"), np.empty(0, np.int64))]
        for at in range(0, len(words), WORDS_AT_ONCE):
            found.append(self._ids(words.slice(at, WORDS_AT_ONCE).to_pylist(), plain))
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        return ids, sizes

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of texts without nulls, one after the other."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary
        plain = pc.match_substring_regex(distinct, rf"^[{_LETTER}]+[{_STOPS}]?$").to_numpy(zero_copy_only=False)
        stopped = distinct.filter(plain)
        bare = pc.ascii_rtrim(stopped, _STOPS)
        stems = pc.utf8_lower(bare).dictionary_encode()
        # One table of stems, single stops, other words and, as its last entry, nothing.
        parts = [self._table(x, p) for x, p in ((stems.dictionary, True), (pa.array(list(_STOPS)), True), (distinct.filter(~plain), False))]
        ids = np.concatenate([i for i, _ in parts])
        sizes = np.concatenate([*(n for _, n in parts), [0]])
        first = len(stems.dictionary)
        # Every distinct word is two entries of the table: a stem and its stop, or itself, and nothing.
        pair = np.full((len(distinct), 2), len(sizes) - 1)
        pair[plain, 0] = stems.indices.to_numpy()
        pair[~plain, 0] = first + len(_STOPS) + np.arange((~plain).sum())
        ends_so = np.flatnonzero(pc.binary_length(stopped).to_numpy() > pc.binary_length(bare).to_numpy())
        stop = pc.index_in(pc.utf8_slice_codeunits(stopped.take(pa.array(ends_so)), -1), pa.array(list(_STOPS)))
        pair[np.flatnonzero(plain)[ends_so], 1] = first + stop.to_numpy()
        ids = _gathered(ids, sizes, pair.ravel())
        sizes = sizes[pair].sum(axis=1)
        order = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        ends = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
        return _gathered(ids, sizes, order), np.diff(ends)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids, sizes = self.encoded(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        return [ids[b - n : b].tobytes() for b, n in zip(ends, sizes, strict=True)]


def _gathered(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The ids of the entries that `order` names, one after the other, given the size of every entry."""
    starts = np.cumsum(sizes) - sizes
    out = [np.empty(0, "<i4")]
    for at in range(0, len(order), WORDS_AT_ONCE):
        some = order[at : at + WORDS_AT_ONCE]
        n = sizes[some]
        place = np.repeat(starts[some] - (np.cumsum(n) - n), n)
        out.append(ids[place + np.arange(len(place))])
    return np.concatenate(out)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about TEXT_BYTES of text; a longer text is a slice of its own."""
    slice_of = np.cumsum(pc.binary_length(batch.column("text")).to_numpy()) // TEXT_BYTES
    starts = np.flatnonzero(np.diff(slice_of, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id at the end of each text."""
    ends = np.cumsum(sizes + 1) - 1
    out = np.empty(len(ids) + len(sizes), ids.dtype)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = ids, end_id
    return out, sizes + 1


_ENCODERS: dict[str, WordEncoder] = {}


def _forget_encoders() -> None:
    _ENCODERS.clear()


def _encoder(path: str) -> WordEncoder:
    remembering(_forget_encoders)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None) -> None:
    """Encode (doc_id, text) and write the ids in ascending doc_id order to `folder`.

    A missing text is an empty one, and with `end_id` every document ends with that id. Rows without a
    doc_id come first; rows of one doc_id stand next to each other in a fixed order (a hash of the
    text), repeated ones included, and may share several files. Other columns are left out. An empty
    table gives files without rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        start = 0
        for batch in batches:
            for part in _slices(batch):
                ids, sizes = encoder.encoded(part.column("text"))
                if end_id is not None:
                    ids, sizes = _with_end(ids, sizes, end_id)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
                starts = pa.array(start + ends - sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), starts, pa.array(sizes), lists],
                    ["doc_id", "start_in_file", "n_tokens", "ids"],
                )
                start += int(sizes.sum())

    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, SCHEMA)
    (
        rows.write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("maxRecordsPerFile", 0)
        .parquet(folder)
    )


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]): `start` counts the ids of all documents before this one.

    Without `ids` only the metadata columns are read. Filters on doc_id reach the page index.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    stored = spark.read.schema(SCHEMA).parquet(folder)
    sizes = stored.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("n"))
    # One row per file, so this window sees as many rows as the write had tasks.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = ["doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens"]
    rows = stored.withColumn("part", part).join(F.broadcast(starts), "part")
    return rows.select(*columns, *(["ids"] if ids else []))


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what `read_tokens` gives."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.mapInArrow(crc, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}/tokens"

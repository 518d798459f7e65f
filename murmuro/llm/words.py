"""Row keys, words and word hashes shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro.runtime import written

WORD = re.compile(r"\w+")
_BREAK = re.compile(r"[ \n]")
# Distinct words whose hash a worker remembers; beyond that it starts anew.
REMEMBERED = 300_000
# Characters cut into words at a time, so that a very long text never becomes one huge list.
PIECE = 1 << 20


def free_name(columns: list[str], name: str) -> str:
    """`name`, with underscores in front until no column is called so (case is ignored, as Spark does)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def keyed(docs: DataFrame, label: str) -> DataFrame:
    """`docs` as (row, doc_id, text), written once: `row` is a key even where doc_id is null or repeated.

    A missing text counts as an empty one. Other columns are left out, so their names cannot clash.
    """
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            text_or_empty().alias("text"),
        ),
        label,
    )


def pieces(text: str) -> Iterator[str]:
    """The text in stretches of about PIECE characters, cut at a blank or line break, which is left out."""
    start = 0
    while len(text) - start > PIECE and (cut := _BREAK.search(text, start + PIECE)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


# Empties what the operator at work remembers.
_FORGET: Callable[[], None] | None = None


def remembering(forget: Callable[[], None]) -> None:
    """A worker, which serves one stage after the other, remembers the words of one operator at a time.

    An operator says by `forget` how its own are emptied; those of the operator before it go.
    """
    global _FORGET
    if forget is not _FORGET:
        if _FORGET:
            _FORGET()
        _FORGET = forget


class _Hashes(dict):
    """Word to its 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def _forget_hashes() -> None:
    _HASHES.clear()


def word_hash(word: str) -> int:
    """64-bit hash of one word."""
    remembering(_forget_hashes)
    return _HASHES[word]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a text, in order."""
    remembering(_forget_hashes)
    parts = []
    for piece in pieces(text.lower()):
        words = WORD.findall(piece)
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of the splitmix generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of every run of `size` words; a shorter text is one shingle, no words give none."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out + words[i : len(words) - size + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(out)

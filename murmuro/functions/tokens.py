"""Tokens and n-grams as array columns: built inside the row, so none of this shuffles."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from murmuro import fixed_values as fixed
from murmuro.functions import text

STOP_WORDS = [*fixed.ENGLISH_STOP_WORDS, *fixed.CUSTOM_STOP_WORDS]


def raw_tokens(c: Column) -> Column:
    """All white-space tokens of the normalised text, contractions split, numbers included."""
    pairs = "|".join(f"{a}(?={b}\\b)" for a, b in fixed.SPLIT_CONTRACTIONS)
    spaced = F.regexp_replace(text.normalise_for_tokens(c), rf"\b({pairs})", "$1 ")
    return F.regexp_extract_all(spaced, F.lit(r"[^\s\x1c-\x1f]+"), 0)


_URL, _TAG = re.compile(fixed.TOKEN_URL, re.ASCII), re.compile(fixed.TOKEN_TAG.removeprefix("(?d)"))
_RUN = re.compile(r"([a-z])\1{2,}")
_PUNCTUATION = dict.fromkeys(map(ord, fixed.PUNCTUATION))
_CONTRACTED = tuple(a + b for a, b in fixed.SPLIT_CONTRACTIONS)
_SPLIT = re.compile(rf"\b({'|'.join(f'{a}(?={b}\\b)' for a, b in fixed.SPLIT_CONTRACTIONS)})", re.ASCII)
# Texts whose tokens are held as Python strings at a time, and tokens that are numbered and counted at a time.
TEXTS, PLACES = 256, 1 << 20


def clean_words(lowered: str, stop: frozenset[str]) -> list[str]:
    """`clean_tokens` of one lower-cased text: every step is left out where the text holds nothing for it."""
    t = lowered
    if "http" in t or "www." in t:
        t = _URL.sub("", t)
    if "<" in t:
        t = _TAG.sub("", t)
    if not t.isascii():
        t = t.encode("ascii", "ignore").decode()
    codes = np.frombuffer(t.encode(), np.uint8)
    same = codes[1:] == codes[:-1]
    # Of runs of one character only those of letters can change a token.
    if (same[1:] & same[:-1] & (codes[2:] >= ord("a"))).any():
        t = _RUN.sub(r"\1\1", t)
    t = t.translate(_PUNCTUATION)
    if any(w in t for w in _CONTRACTED):
        t = _SPLIT.sub(r"\1 ", t)
    return [w for w in t.split() if w not in stop and w.isalpha()]


def clean_tokens(c: Column, stop_words: list[str] | None = None) -> Column:
    """Alphabetic tokens of `raw_tokens` that are no stop words, in order."""
    stop = frozenset(STOP_WORDS if stop_words is None else stop_words)

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        parts = (texts.slice(at, TEXTS).to_pylist() for at in range(0, len(texts), TEXTS))
        return pa.concat_arrays([pa.array([], kind), *(pa.array([clean_words(t, stop) for t in part], kind) for part in parts)])

    return cut(F.lower(F.coalesce(c, F.lit(""))))


def words(c: Column) -> Column:
    """Lower-cased words: runs of letters and apostrophes."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}']+"), 0)


def feature_tokens(c: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-cased runs of two or more word characters without stop words."""
    stop = fixed.ENGLISH_STOP_WORDS if stop_words is None else stop_words
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]{2,}"), 0), lambda t: ~t.isin(stop))


def tag_tokens(c: Column) -> Column:
    """Words, numbers and sentence punctuation in their original case."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+(?:'[\p{L}]+)?|[.,!?;:]"), 0)


def ngrams(tokens: Column, n: int) -> Column:
    """Adjacent n-grams joined by a space."""
    starts = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    shifted = [F.slice(tokens, j + 1, starts) for j in range(n)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat_ws(" ", x, y)), shifted)


def gram_counts(lists: pa.Array, n: int, among: pa.Array | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Distinct n-grams of token lists, on request only of some words, and their counts, of `PLACES` places at a time."""
    flat, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
    for at in range(0, len(flat), PLACES):
        part = flat.slice(at, PLACES + n - 1).dictionary_encode()
        names, ids = part.dictionary, part.indices.to_numpy().astype(np.int64)
        starts = np.flatnonzero(left[at : at + PLACES] >= n)
        if among is not None:
            wanted = pc.is_in(names, among).to_numpy(zero_copy_only=False)[ids]
            starts = starts[np.logical_and.reduce([wanted[starts + j] for j in range(n)])]
        # As many words as places, so three numbers fit into 63 bits.
        key = reduce(lambda k, j: k * len(names) + ids[starts + j], range(1, n), ids[starts])
        keys, counts = np.unique(key, return_counts=True)
        parts: list[pa.Array] = []
        for _ in range(n):
            keys, last = np.divmod(keys, len(names))
            parts.insert(0, names.take(pa.array(last)))
        yield (pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]), counts


def list_terms(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """(list, term, uses, names) of the words and word pairs of token lists: numbers of list and term, and the terms' names.

    A null parts what stands before and after it. Lists of about `PLACES` tokens together are taken at a time.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(lists):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + PLACES, "right")))
        part = lists.slice(at, stop - at).flatten().dictionary_encode()
        names, ids = part.dictionary, pc.fill_null(part.indices, -1).to_numpy().astype(np.int64)
        size, owner = len(names), np.repeat(np.arange(at, stop), sizes[at:stop])
        word = np.flatnonzero(ids >= 0)
        pair = np.flatnonzero((owner[1:] == owner[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0))
        terms = np.concatenate([ids[word], size + ids[pair] * size + ids[pair + 1]])
        width = size + size * size
        found, uses = np.unique((np.concatenate([owner[word], owner[pair]]) - at) * width + terms, return_counts=True)
        if len(found):
            owner, terms = np.divmod(found, width)
            distinct, number = np.unique(terms, return_inverse=True)
            one, two = np.divmod(distinct[distinct >= size] - size, size)
            pairs = pc.binary_join_element_wise(names.take(pa.array(one)), names.take(pa.array(two)), " ")
            yield owner + at, number, uses, pa.concat_arrays([names.take(pa.array(distinct[distinct < size])), pairs])
        at = stop


def word_tag(c: Column) -> Column:
    """The pattern tagger: suffix rules, first match wins, then numbers, noun otherwise."""
    tag = F.when(c.rlike(fixed.NUMBER), F.lit(fixed.NUMBER_TAG)).otherwise(fixed.OTHER_TAG)
    for ending, name in reversed(fixed.SUFFIX_TAGS):
        tag = F.when(c.endswith(ending), F.lit(name)).otherwise(tag)
    return tag


def default_tag(c: Column, lowered: Column | None = None) -> Column:
    """The pattern tagger behind a table of closed-class words and punctuation."""
    lowered = F.lower(c) if lowered is None else lowered
    closed = F.lit(None).cast("string")
    for name, members in reversed(fixed.CLOSED_CLASS.items()):
        closed = F.when(lowered.isin(members), F.lit(name)).otherwise(closed)
    every = [w for members in fixed.CLOSED_CLASS.values() for w in members]
    return (
        F.when(c.isin(list(fixed.SENTENCE_MARKS)), F.lit("."))
        .when(lowered.isin(every), closed)
        .otherwise(word_tag(c))
    )


def tagged(c: Column) -> Column:
    """Text as an array of (word, tag)."""
    words = tag_tokens(c)
    return F.zip_with(
        words, F.transform(words, F.lower), lambda w, low: F.struct(w.alias("word"), default_tag(w, low).alias("tag"))
    )


def emojis(c: Column) -> Column:
    return text.emojis(c)

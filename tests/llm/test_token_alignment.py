"""Token alignment against a plain walk over both token lists."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from murmuro.llm import catalog, token_alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, chunk string, row string, pair string"


def decoders():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)

    def piece(i):
        byte = re.fullmatch("<0x(..)>", b.id_to_piece(i))
        return bytes([int(byte[1], 16)]) if byte else b.id_to_piece(i).replace("▁", " ").encode()

    return a, b, lambda i: bytes(of[c] for c in a.id_to_token(i)), piece


def ends_of(ids, spelled):
    ends, at = [], 0
    for i in ids:
        at += len(spelled(i))
        ends.append(at)
    return ends


def by_definition(rows):
    a, b, a_bytes, b_bytes = decoders()
    docs, uses = [], Counter()
    for doc_id, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            x, y = [], []
        x_ends, y_ends = ends_of(x, a_bytes), ends_of(y, b_bytes)
        cuts = sorted({*x_ends} & {*y_ends})
        links = [(x[x_ends.index(c)], y[y_ends.index(c)]) for c in cuts]
        groups, low = [], 0
        for c in cuts:
            sides = [[i for i, e in zip(ids, ends, strict=True) if low < e <= c] for ids, ends in ((x, x_ends), (y, y_ends))]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
            low = c
        uses.update(links)
        docs.append((doc_id, x, y, groups, links))
    most = {}
    for (_, piece), n in uses.items():
        most[piece] = max(most.get(piece, 0), n)
    out = []
    for doc_id, x, y, groups, links in docs:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""
        best = sum(uses[p] == most[p[1]] for p in links)
        out.append((doc_id, len(x), len(y), len(groups), len(links), best, sum(uses[p] for p in links), sha))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "c", "r", "p") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, token_alignment.alignment(df, A_FILE, B_FILE).collect()), key=str)


MESSY = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "a ▁ word"),
    (5, "plain words and a ▁mark"),
    (6, "two  blanks\n\n and\ttabs   x <|endoftext|> <s> </s> <0x41> end "),
    (7, "日本語 テキスト é é 👍🏽 \x00 \x1c a\x85b"),
    (None, "plain words"),
    (8, "plain words"),
    (8, "plain words"),
    (9, "x" * 5_000 + " " + "ab1" * 2_000),
    (10, " leading and trailing "),
]


def test_messy_texts(spark):
    assert found(spark, MESSY) == by_definition(MESSY)


def test_texts_of_random_characters(spark):
    r = random.Random(5)
    letters = "ab é  \n\t.'9<|>日▁ü" + "theing "
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randrange(1, 60)))) for i in range(300)]
    assert found(spark, rows) == by_definition(rows)


def test_many_chunks(spark, monkeypatch):
    # The size of a chunk is set where tasks run, so the documents do it: each of these is a chunk of its own.
    rows = [(i, f"some words of number {i} " * 5) for i in range(40)] + MESSY
    df = spark.createDataFrame([(*r, "c", "r", "p") for r in rows], SCHEMA).repartition(20)
    got = token_alignment.alignment(df, A_FILE, B_FILE).collect()
    assert sorted(map(tuple, got), key=str) == by_definition(rows)


def test_chunks_and_memory_are_bounded(monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED", 3)
    aligner = token_alignment.Aligner(A_FILE, B_FILE)
    for text in ["one two three four five", "six seven one", "eight ▁ nine"]:
        found, sizes = aligner.chunk([text, None])
        assert len(aligner.known) <= 8
    assert len(found) == 0 and sizes.tolist() == [0, 0]


def test_no_rows(spark):
    assert token_alignment.alignment(spark.createDataFrame([], SCHEMA), A_FILE, B_FILE).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op13_token_alignment"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == by_definition(rows)


@pytest.mark.parametrize("seed", range(20))
def test_pointer_jumping_finds_components(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 200))
    a, b = (np.append(np.flatnonzero(r.random(n - 1) < p) + 1, n) for p in r.random(2))
    a_group, b_group, n_groups = token_alignment.aligned(a, b)
    cuts = np.intersect1d(a, b)
    assert n_groups == len(cuts)
    assert (a_group == np.searchsorted(cuts, a)).all() and (b_group == np.searchsorted(cuts, b)).all()


def test_stretches_have_the_tokens_of_the_whole_text():
    """What the cut of texts into stretches rests on, in front of blanks, line breaks and stops."""
    aligner = token_alignment.Aligner(A_FILE, B_FILE)
    r = random.Random(11)
    for _ in range(300):
        text = "".join(r.choice(["word", "it's", "é", "12", ".", ",", "!?", " ", " ", "\n", "  ", "Ünd", "x", "\t", "日"]) for _ in range(30))
        stretches = aligner.cut.split(f" {text}")
        assert "".join(stretches) == f" {text}"
        b = [i for ids in aligner._pieces(stretches) for i in ids]
        a = [i for s in stretches for i in aligner.a.encode(s, add_special_tokens=False).ids]
        assert b == aligner.b.encode(text) and a == aligner.a.encode(f" {text}", add_special_tokens=False).ids
    assert aligner.cut.split(" one two, three.\nFour") == [" one", " two", ",", " three", ".", "\nFour"]

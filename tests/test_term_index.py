"""The inverted index against scoring every document."""

from __future__ import annotations

import numpy as np
import pytest

from murmuro.operators import retrieval, term_index
from murmuro.operators.term_index import TermIndex

TEXTS = [
    "a cat sat on a mat", "the dog", "a dog and a cat", "", None, "mat mat mat", "the the the cat", "A Cat", "café au lait", "a", "a",
]


def table(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)


def asked(spark, *texts):
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "query_id string, text string")


def rows(df):
    return sorted((q, r, d, round(s, 5)) for q, r, d, s in map(tuple, df.collect()))


def random_texts(n, seed):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    return [" ".join(r.choice(words, r.integers(1, 60), p=share / share.sum())) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    # Copies give ties, one text is very long.
    made = random_texts(900, 1)
    return [*made, *made[:40], " ".join(made), *TEXTS]


@pytest.mark.parametrize("k", [1, 6, 2000])
def test_ranks_are_those_of_the_plain_search(spark, texts, k, tmp_path):
    index = TermIndex.build(table(spark, texts), str(tmp_path / "i"))
    queries = asked(spark, "w1 w50 w200", "w399", "cat cat mat", "nothing here", "", "a the w0", *random_texts(20, 2))
    assert rows(index.search(queries, k)) == rows(retrieval.lexical(queries, table(spark, texts), k))


def test_appended_rows(spark, texts, tmp_path):
    index = TermIndex.build(table(spark, texts[:300]), str(tmp_path / "i"))
    index.append(table(spark, texts[300:], 300))
    queries = asked(spark, *random_texts(10, 3))
    assert rows(TermIndex(spark, index.path).search(queries)) == rows(retrieval.lexical(queries, table(spark, texts)))


def test_rare_terms_leave_blocks_out(spark, texts, tmp_path):
    index = TermIndex.build(table(spark, texts), str(tmp_path / "i"))
    told = {r.query_id: r for r in index.effort(asked(spark, "w0 w1 w2 w3", "w300 w0"), 3).collect()}
    assert all(r.scored <= r.blocks for r in told.values()) and told["q1"].scored < told["q1"].blocks


def test_no_rows(spark, tmp_path):
    empty = TermIndex.build(table(spark, ["x"]).where("false"), str(tmp_path / "i"))
    assert empty.search(asked(spark, "x")).collect() == []
    one = TermIndex.build(table(spark, ["x y"]), str(tmp_path / "j"))
    assert one.search(asked(spark, "x").where("false")).collect() == []


@pytest.mark.parametrize("block,lot", [(1, 1), (3, 2), (16, 32)])
def test_blocks_and_lots_do_not_change_results(monkeypatch, texts, block, lot):
    monkeypatch.setattr(term_index, "BLOCK", block)
    monkeypatch.setattr(term_index, "LOT", lot)
    tokens = [(t or "").split() for t in texts]
    made = term_index.shard_rows("s", list(range(len(tokens))), tokens)
    lengths, doc_ids = np.asarray(made["lengths"][0]), np.asarray(made["doc_ids"][0])
    weight = {"w1": 1.5, "w20": 3.0, "cat": 2.0, "w0": -0.2}
    terms = [
        (*(np.asarray(made[c][i]) for c in ("places", "counts", "blocks", "most", "shortest")), [{"query_id": 1, "weight": weight[t]}])
        for i, t in enumerate(made["term"])
        if t in weight
    ]
    best, effort = {}, []
    term_index.search_shard(terms, doc_ids, lengths, best, effort, 9, 1.5, 0.75, lengths.mean())
    score = {}
    for i, words in enumerate(tokens):
        if hit := [t for t in weight if t in words]:
            damped = 1.5 * (0.25 + 0.75 * len(words) / lengths.mean())
            score[i] = round(sum(weight[t] * words.count(t) * 2.5 / (words.count(t) + damped) for t in hit), 6)
    want = sorted(score, key=lambda i: (-score[i], i))[:9]
    assert best[1][0].tolist() == want and np.allclose(best[1][1], [score[i] for i in want], atol=2e-6)


def test_a_shard_holds_a_few_bytes_per_token():
    """Tokens are numbers as soon as they are read, and rows are made a part at a time."""
    import tracemalloc

    made = [t.split() for t in random_texts(400, 5)]
    tracemalloc.start()
    held, n, rows_made = term_index._Shard(), 0, 0
    for i in range(12_000):
        # New string objects, as from a text.
        tokens = " ".join(made[i % 400]).split()
        held.add(i, tokens)
        n += len(tokens)
    for part in held.rows("s", entries=5_000):
        rows_made += len(part["term"])
        assert part["term"] == [None] or len(part["n"]) == 1 or sum(part["n"]) <= 5_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows_made == 1 + len({t for m in made for t in m}) and peak < 50 * n


@pytest.mark.parametrize("entries", [1, 7, 1 << 18])
def test_parts_of_a_shard_are_the_whole_shard(texts, entries):
    held = term_index._Shard()
    for i, t in enumerate(texts[:60]):
        held.add(i, (t or "").split())
    found = {}
    docs = None
    for part in held.rows("s", entries):
        for i, term in enumerate(part["term"]):
            if term is None:
                docs = part["doc_ids"][i]
            else:
                assert term not in found
                found[term] = {docs[p]: c for p, c in zip(part["places"][i].tolist(), part["counts"][i].tolist(), strict=True)}
    want = {}
    for i, t in enumerate(texts[:60]):
        for w in (t or "").split():
            want.setdefault(w, {}).setdefault(i, 0)
            want[w][i] += 1
    assert found == want and list(found) == sorted(found)

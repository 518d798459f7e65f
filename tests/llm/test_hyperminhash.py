"""HyperMinHash near-duplicate removal against brute force over full shingle sets."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from murmuro.llm import catalog, hyperminhash
from murmuro.llm.words import mixed

SCHEMA = "doc_id bigint, text string, row bigint, same string, n string"
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def by_definition(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders.get(g, []))
        for j, k in common.items():
            if 100 * k >= 85 * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
        for g in s:
            holders.setdefault(g, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), component, d == component))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 5, "s", "n") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, hyperminhash.near_duplicates(df).collect()), key=str)


def varied(seed, n_words, copies, changes):
    """A text and copies of it in each of which some words are replaced."""
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(n_words)]
    out = [base]
    for c in range(copies):
        text = list(base)
        for k in range(changes):
            text[r.randrange(n_words)] = f"new{seed}x{c}x{k}"
        out.append(text)
    return [" ".join(t) for t in out]


def texts():
    out = []
    for seed in range(25):
        out += varied(seed, random.Random(seed).choice([8, 12, 20, 40, 90, 400]), 4, 1 + seed % 3)
    # A chain: each text is similar to the next one, the first and the last are not.
    words = [f"c{i}" for i in range(120)]
    out += [" ".join(words[k : k + 60]) for k in range(0, 30, 2)]
    return out


MESSY = [
    (None, "only without an id and nothing else here"),
    (None, "Both With AND without an id"),
    (3, "both with and\tWITHOUT an  id"),
    (4, None),
    (5, ""),
    (6, " \n\x0b"),
    (7, "two words"),
    (8, "TWO\x0cwords"),
    (8, "TWO\x0cwords"),
    (9, "É é É"),
    (10, "é é é"),
    (11, "a\x1cb c"),
    (12, "a b c d"),
    (13, " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(200_000))),
]


def test_components_are_those_of_brute_force(spark):
    rows = list(enumerate(texts(), 100)) + MESSY
    assert found(spark, rows) == by_definition(rows)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    # A group of copies, and two groups that stand so close that only full sets tell them apart.
    rows = varied(1, 60, 30, 1) + varied(2, 200, 20, 9)
    rows += [f"{t} {' '.join(f'z{i}' for i in range(34))}" for t in varied(2, 200, 20, 2)]
    rows = list(enumerate(rows)) + MESSY
    assert found(spark, rows) == by_definition(rows)


def test_no_rows(spark):
    assert hyperminhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op12_hyperminhash"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == by_definition(rows)


def test_registers_hold_leading_zeros_and_mantissa():
    grams = np.arange(1, 5000, dtype=np.uint64)
    got = hyperminhash.sketch(grams)
    hashes = [int(h) for h in mixed(grams)]
    for bucket in range(hyperminhash.BUCKETS):
        least = min((h << 7 & (1 << 64) - 1) >> 11 for h in hashes if h >> 57 == bucket)
        bits = f"{least:053b}"
        zeros = bits.index("1")
        mantissa = int(bits[zeros + 1 : zeros + 1 + hyperminhash.MANTISSA].ljust(hyperminhash.MANTISSA, "0"), 2)
        assert got[bucket] == (zeros << hyperminhash.MANTISSA) + mantissa + 1


def test_empty_buckets_borrow():
    registers = np.zeros(hyperminhash.BUCKETS, np.uint16)
    registers[[3, 90]] = [7, 9]
    full = hyperminhash.densified(registers)
    assert set(full) == {7, 9} and full[3] == 7 and full[90] == 9
    assert 30 < (full == 7).sum() < 98


@pytest.mark.parametrize("share", [0.0, 0.5, 0.85, 1.0])
def test_estimate_is_corrected_for_collisions(share):
    got = []
    for seed in range(60):
        pool = np.unique(mixed(np.arange(seed * 10**6, seed * 10**6 + 4000, dtype=np.uint64)))
        # A and B of equal size with the wanted Jaccard similarity.
        common = int(round(2 * 1000 * share / (1 + share)))
        a, b = pool[:1000], np.concatenate([pool[:common], pool[1000 : 2000 - common]])
        n = np.asarray([len(a)])
        score, used = hyperminhash.estimated(hyperminhash.sketch(a)[None], hyperminhash.sketch(b)[None], n, n)
        got.append(score[0])
    assert abs(np.mean(got) - share) < 0.02


def test_expected_collisions_match_trials():
    n = 400
    same = []
    for seed in range(400):
        pool = mixed(np.arange(seed * 10**6, seed * 10**6 + 2 * n, dtype=np.uint64))
        a, b = hyperminhash.sketch(pool[:n]), hyperminhash.sketch(pool[n:])
        same.append(((a == b) & (a > 0)).sum())
    want = hyperminhash.expected_collisions(np.asarray([n]), np.asarray([n]))[0]
    assert abs(np.mean(same) - want) < 4 * np.sqrt(want / len(same)) + 0.005


def test_bands_reach_the_recall():
    bands, rows = hyperminhash.choose_rows(0.85)
    assert bands * rows <= hyperminhash.BUCKETS
    assert 1 - (1 - 0.85**rows) ** bands >= hyperminhash.RECALL

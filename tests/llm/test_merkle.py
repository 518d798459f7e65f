"""The Merkle manifest against the definition, row by row."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pyarrow.parquet as pq
import pytest

from murmuro.llm import catalog, merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, lo bigint, digest string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
LOWERED = str.maketrans(merkle.UPPER, merkle.LOWER)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def proof(tree, i):
    steps = []
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        steps.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return steps


def by_definition(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, leaf(r, r[4])))
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in names:
        trees[k].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    built = {k: levels([d for _, d in trees[k]]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    out = []
    for t, k in enumerate(names):
        for i, (r, own) in enumerate(trees[k]):
            steps = proof(built[k], i) + proof(top, t)
            digest = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                digest = leaf(r, r[4].translate(LOWERED))
            for before, after in steps:
                digest = h(*before, digest, *after)
            siblings = h(*[d for before, after in steps for d in before + after])
            out.append((r[0], own, built[k][-1][0], top[-1][0], siblings, digest, digest == top[-1][0]))
    return sorted(out, key=str)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, merkle.manifest(df).collect()), key=str)


def rows_of(n, lang, first=0):
    return [(first + i, f"s{i % 3}", lang, i, f"Text Number {i} É") for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        rows_of(1, "en"),
        rows_of(8, "en"),
        rows_of(9, "en") + rows_of(1, None, 50),
        # More than eight languages, null and empty ones, trees of one to four levels.
        rows_of(600, "en", -200) + rows_of(65, "de", 700) + rows_of(3, None, 900) + rows_of(2, "", 950)
        + [r for k in range(12) for r in rows_of(1 + k % 3, f"l{k}é", 1000 + 10 * k)],
        # Nulls anywhere, ties and rows that are repeated.
        [(1, None, None, None, None)] * 11 + [(1, "", "en", 0, "")] * 9 + [(None, "a", "en", 5, "ABC")] * 3
        + [(2, "a", "en", 5, "ABC"), (2, "a", "en", 5, "ABD"), (3, "a", "en", 5, "Z" * 100_000)],
    ],
)
def test_manifest_follows_the_definition(spark, rows):
    assert manifest(spark, rows) == by_definition(rows)


def test_untampered_rows_verify_and_tampered_ones_with_capitals_do_not(spark):
    got = manifest(spark, rows_of(100, "en"))
    assert all(r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0) for r in got)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered_query_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    want = by_definition([tuple(r.values()) for r in pq.read_table(f"{folder}/documents.parquet").select(COLUMNS).to_pylist()])
    assert sorted(map(tuple, catalog.QUERIES["op11_merkle"](spark, folder).collect()), key=str) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    assert sorted(con.sql(catalog.SQL["op11_merkle"]).fetchall(), key=str) == want

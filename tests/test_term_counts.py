"""Tokens, n-gram counts and keywords that are counted per batch."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmuro import runtime
from murmuro.functions import tokens
from murmuro.operators import keywords, lexical, retrieval

ODD = [
    "Cannot stop; GIMME 111cannot soooo gooood a---b aa.a 12ab",
    "see http://x.y/z?q=<b> now www.a.b end <i\nkept> <b>bold</b> café Kelvin İx",
    "one\x0btwo\x1cthree four five \x00cannot x\x00\x00\x00y ___gonna___ wanna.be",
    "", None, "...", "lemme lemmes agotta gotta!!! <<>> <a",
]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")


def test_clean_tokens_are_the_alphabetic_raw_tokens(spark):
    raw = tokens.raw_tokens(F.col("text"))
    plain = F.filter(raw, lambda t: t.rlike("^[a-z]+$") & ~t.isin(tokens.STOP_WORDS))
    df = texts(spark, *ODD)
    assert df.select(tokens.clean_tokens(F.col("text"))).collect() == df.select(plain).collect()


@pytest.mark.parametrize("places", [3, 5, 1 << 20])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_grams_are_counted_in_parts(monkeypatch, places, n):
    monkeypatch.setattr(tokens, "PLACES", places)
    lists = [["a", "b", "a", "b", "c"], [], None, ["b", "a"], ["a", "b", "a", "b"]]
    want = Counter(" ".join(x[i : i + n]) for x in lists if x for i in range(len(x) - n + 1))
    got = Counter()
    for grams, counts in tokens.gram_counts(pa.array(lists, pa.list_(pa.string())), n):
        got.update(dict(zip(grams.to_pylist(), counts.tolist(), strict=True)))
    assert got == want


@pytest.mark.parametrize("places", [3, 1 << 20])
def test_terms_of_lists(monkeypatch, places):
    monkeypatch.setattr(tokens, "PLACES", places)
    lists = [["a", "b", "a", "b"], [], None, ["b", None, "a", "c"]]
    got = {}
    for owner, number, uses, names in tokens.list_terms(pa.array(lists, pa.list_(pa.string()))):
        got |= {(o, names[k].as_py()): u for o, k, u in zip(owner.tolist(), number.tolist(), uses.tolist(), strict=True)}
    assert got == {(0, "a"): 2, (0, "b"): 2, (0, "a b"): 2, (0, "b a"): 1, (3, "b"): 1, (3, "a"): 1, (3, "c"): 1, (3, "a c"): 1}


def plain_keywords(values, n=8):
    """Keywords of (key, text without stop words), one term after the other."""

    def terms(t):
        w = (t or "").split()
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    df = Counter(x for _, t in values for x in set(terms(t)))
    tf: dict = {}
    for key, t in values:
        if terms(t):
            tf.setdefault(key, Counter()).update(terms(t))
    score = lambda c, x: c[x] * (math.log((1 + len(values)) / (1 + df[x])) + 1)
    out = {}
    for key, c in tf.items():
        kept = []
        for x in sorted(c, key=lambda x: (-score(c, x), x)):
            if len(kept) < n and not any(keywords._alike(x, k, 0.9) for k in kept):
                kept.append(x)
        out[key] = kept
    return out


def many(seed=7):
    rng = random.Random(seed)
    words = [f"q{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    values = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60, 200])))) for i in range(60)]
    # One comment whose best terms are all alike, one key that comes twice.
    alike = " ".join(f"{'x' if k else ''}" + "abcdefghijklmnopqrst" + chr(97 + k % 26) + "uvwxyz" * 3 for k in range(26) for _ in range(4))
    return [*values, (60, alike + " " + " ".join(words[:40])), (3, "qbal qbel qbal"), (61, None)]


@pytest.mark.parametrize("travels", [0, 20, 200_000])
def test_keywords_of_the_best_terms_are_those_of_all(spark, monkeypatch, travels):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", travels)
    values = many()
    df = spark.createDataFrame(values, "doc_id bigint, text string").repartition(3)
    assert {r.doc_id: r.keywords for r in keywords.keywords(df).collect()} == plain_keywords(values)


def test_few_terms_are_looked_up(spark, monkeypatch):
    seen = []
    write = keywords.written

    def noted(df, label):
        out = write(df, label)
        seen.append((label, out))
        return out

    monkeypatch.setattr(keywords, "written", noted)
    values = [(i, " ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26)} zz{chr(97 + i)}" * (1 + j % 3) for j in range(300))) for i in range(8)]
    keywords.keywords(spark.createDataFrame(values, "doc_id bigint, text string")).count()
    (rows,) = [x.count() for label, x in seen if label == "keyword-candidates"]
    assert rows < 0.5 * sum(len({*t.split()}) for _, t in values)


@pytest.mark.parametrize("span", [False, True])
def test_rare_words_are_left_out_of_frequent_grams(spark, monkeypatch, span):
    asked = []
    plain = lexical.count_ngrams
    monkeypatch.setattr(lexical, "count_ngrams", lambda *a: asked.append(a[4]) or plain(*a))
    monkeypatch.setattr(lexical, "PART", 2)
    values = [f"red car stop red car turn left soon q{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    df = texts(spark, *values)
    got = [tuple(r) for r in lexical.top_ngrams(df, 2, 4, span).collect()]
    assert asked[0] is None and 0 < asked[1].count() < 10
    arrays = lexical.token_arrays(df)
    want = plain(arrays, 2, span).orderBy(F.desc("count"), "gram").limit(4)
    assert got == [tuple(r) for r in want.collect()]


def test_lexical_scores_where_the_texts_lie(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 50])))) for i in range(600)] + [(600, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame([(q, " ".join(rng.choices(words, k=4))) for q in range(9)] + [(9, "w1 w1"), (10, "none")], "query_id bigint, text string")
    grouped = []
    plain = retrieval._grouped_scores
    monkeypatch.setattr(retrieval, "_grouped_scores", lambda *a: grouped.append(1) or plain(*a))
    got = sorted(map(tuple, retrieval.lexical(asked, df).collect()))
    assert not grouped
    monkeypatch.setattr(retrieval, "is_small", lambda table: False)
    assert got == sorted(map(tuple, retrieval.lexical(asked, df).collect())) and grouped
    monkeypatch.undo()
    twice = df.unionByName(df.where("doc_id < 50"))
    few = sorted(map(tuple, retrieval.lexical(asked, twice).collect()))
    monkeypatch.setattr(retrieval, "is_small", lambda table: False)
    assert few == sorted(map(tuple, retrieval.lexical(asked, twice).collect()))

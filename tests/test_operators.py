"""Scoring, tagging, relations, retrieval, chunks on hand-made rows with worked-out results."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmuro import runtime
from murmuro.operators import (
    chunking,
    classify,
    clean,
    entities,
    evaluate,
    keywords,
    lexical,
    lexicon,
    relations,
    report,
    retrieval,
    spelling,
    tagging,
    topics,
)
from murmuro.plans.enrich import enrich
from murmuro.streaming import ingest


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")


# Sentiment


@pytest.mark.parametrize(
    "sentence, valence",
    [
        ("good", 1.9),
        ("not good", 1.9 * -0.74),
        ("not that much good", 1.9 * -0.74),
        ("not a b c good", 1.9),
        ("very good", 1.9 + 0.293),
        ("slightly bad", -2.5 + 0.293),
        ("GOOD day", 1.9 + 0.733),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("good!!!!!!", 1.9 + 4 * 0.292),
        ("bad??", -2.5 - 2 * 0.18),
        ("nothing here", 0.0),
    ],
)
def test_rule_sentiment(spark, sentence, valence):
    lex = runtime.fixed_table(spark, [("good", 1.9), ("bad", -2.5)], "word string, valence double")
    got = lexicon.with_sentiment(texts(spark, sentence), "rules", lex).first()
    expected = round(valence / math.sqrt(valence * valence + 15), 4)
    assert got["sentiment_score"] == pytest.approx(expected, abs=1e-4)
    assert got["sentiment"] == ("positive" if expected >= 0.05 else "negative" if expected <= -0.05 else "neutral")


def test_polarity_and_unknown_method(spark):
    lex = runtime.fixed_table(
        spark, [("good", 0.5, 0.6), ("bad", -0.5, 0.2)], "word string, polarity double, subjectivity double"
    )
    df = lexicon.with_polarity(texts(spark, "good bad", "Good!", None, "x"), lex).orderBy("doc_id")
    assert [(r["polarity"], r["subjectivity"]) for r in df.collect()] == [(0.0, 0.4), (0.5, 0.6), (0.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError):
        lexicon.with_sentiment(texts(spark, "x"), "other")


def test_emotions(spark):
    lex = runtime.fixed_table(spark, [("war", "fear"), ("war", "anger"), ("fun", "joy")], "word string, emotion string")
    df = texts(spark, "war war fun", "fun", "none")
    totals = dict(rows(lexicon.emotion_totals(df, lex)))
    assert totals["fear"] == 2 and totals["joy"] == 2 and totals["trust"] == 0 and len(totals) == 8
    best = rows(lexicon.top_emotion_comments(df, lex, "joy").orderBy(F.desc("intensity")))
    assert [(b[0], b[2]) for b in best] == [(1, 1.0), (0, 0.2)]


# Relations: the five fixtures


def tagged(spark, *comments):
    data = [(f"c{i}", p, w, t) for i, c in enumerate(comments) for p, (w, t) in enumerate(c)]
    return relations.from_token_rows(spark.createDataFrame(data, "comment_id string, pos int, token string, tag string"))


RELEASED = [("Rockstar", "NNP"), ("released", "VBD"), ("trailer", "NN")]


def test_relation_string_and_triple(spark):
    assert rows(relations.relation_strings(tagged(spark, RELEASED), "comment_id")) == [("c0", 0, "released(Rockstar, trailer)")]
    fans = [("Fans", "NNS"), ("love", "VBP"), ("the", "DT"), ("graphics", "NNS")]
    assert rows(relations.relation_triples(tagged(spark, fans), "comment_id")) == [("c0", 0, "Fans", "love", "graphics")]


def test_relations_are_distinct(spark):
    got = relations.distinct_relations(tagged(spark, RELEASED, RELEASED), "comment_id")
    assert [r["relation"] for r in got.collect()] == ["released(Rockstar, trailer)"]


def test_noun_chunks(spark):
    words = [("Grand", "NNP"), ("Theft", "NNP"), ("Auto", "NNP"), ("trailer", "NN"), ("impressed", "VBD"), ("fans", "NNS")]
    assert rows(relations.noun_chunks(tagged(spark, words), "comment_id")) == [("c0", 0, "Grand Theft Auto trailer")]


def test_graph_dot(spark):
    edges = relations.graph_edges(relations.relation_triples(tagged(spark, RELEASED), "comment_id"))
    dot = relations.graph_dot(edges).first()["dot"]
    assert dot.startswith("digraph KG") and '"rockstar" -> "trailer" [label="released"];' in dot


# Taggers

SENTENCES = [
    [("the", "DT"), ("run", "NN"), ("ends", "VBZ")],
    [("they", "PRP"), ("run", "VBP"), ("fast", "RB")],
    [("they", "PRP"), ("run", "VBP"), ("home", "NN")],
    [("we", "PRP"), ("run", "VBP"), ("home", "NN")],
    [("a", "DT"), ("fast", "JJ"), ("run", "NN")],
    [("the", "DT"), ("fast", "JJ"), ("run", "NN")],
]


def token_rows(spark, sentences):
    data = [(str(i), p, w, t) for i, s in enumerate(sentences) for p, (w, t) in enumerate(s)]
    return spark.createDataFrame(data, "sent_id string, pos int, word string, tag string")


def test_ngram_taggers_back_off(spark):
    train = token_rows(spark, SENTENCES)
    model = tagging.train_ngram_taggers(train)
    test = token_rows(spark, [[("the", ""), ("run", ""), ("jumping", "")], [("they", ""), ("run", ""), ("42", "")]])
    got = {(r["sent_id"], r["pos"]): r for r in tagging.tag_with_ngrams(test, model).collect()}
    assert got[("0", 1)]["unigram"] == "NN" and got[("0", 1)]["bigram"] == "NN"
    assert got[("1", 1)]["bigram"] == "VBP" and got[("1", 1)]["trigram"] == "VBP"
    assert got[("0", 2)]["trigram"] == "VBG" and got[("1", 2)]["trigram"] == "CD"


def test_hmm_equals_brute_force(spark):
    train = token_rows(spark, SENTENCES)
    first, steps, emitted = model = tagging.train_hmm(train)
    pi, a = {r["tag"]: r["logp"] for r in first.collect()}, {(r["t1"], r["tag"]): r["logp"] for r in steps.collect()}
    b = {(r["word"], r["tag"]): r["logp"] for r in emitted.collect()}
    tags = sorted({t for s in SENTENCES for _, t in s})
    got = {(r["sent_id"], r["pos"]): r["hmm"] for r in tagging.tag_with_hmm(train, model).collect()}
    never = -math.inf
    for i, sentence in enumerate(SENTENCES):
        words = [w for w, _ in sentence]

        def logp(path):
            total = pi.get(path[0], never) + b.get((words[0], path[0]), never)
            for j in range(1, len(words)):
                total += a.get((path[j - 1], path[j]), never) + b.get((words[j], path[j]), never)
            return total

        best = max(itertools.product(tags, repeat=len(words)), key=logp)
        assert logp([got[(str(i), j)] for j in range(len(words))]) == pytest.approx(logp(best))


def test_compare_taggers(spark):
    train = token_rows(spark, SENTENCES)
    ngram = tagging.tag_with_ngrams(train, tagging.train_ngram_taggers(train))
    hmm = tagging.tag_with_hmm(train, tagging.train_hmm(train)).where("word <> 'home'")
    compared = tagging.compare_taggers(ngram, hmm, train)
    assert compared.where("word = 'home' AND hmm = ''").count() == 2
    shares = {(r["first"], r["second"]): r["share"] for r in tagging.agreement(compared, ["default", "trigram"]).collect()}
    assert shares[("default", "trigram")] == 1.0


# Spelling


def test_spelling(spark):
    dictionary = runtime.fixed_table(
        spark, [("world", 10), ("word", 50), ("hello", 5), ("help", 9), ("held", 9)], "term string, freq bigint"
    )
    df = texts(spark, "helo wrld hello xyzxyz w0rld wrod helq", "")
    got = dict(rows(spelling.correct_text(df, dictionary)))
    # helo and helq: help and held are one edit away and equally frequent, held comes first; wrld: world at one edit
    # beats word at two; wrod: a swap counts as two edits.
    assert got[0] == "held world hello xyzxyz w0rld word held"
    assert got[1] == ""


def brute(word, terms):
    def distance(a, b):
        previous = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
            previous = row
        return previous[-1]

    ranked = sorted((distance(word, t), -f, t) for t, f in terms if distance(word, t) <= 2)
    return ranked[0][2] if ranked else None


def test_spelling_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(1, 7))) for _ in range(120)})
    terms = [(w, int(rng.integers(1, 5))) for w in words[::3]]
    dictionary = runtime.fixed_table(spark, terms, "term string, freq bigint")
    got = {r["word"]: r["term"] for r in spelling.corrections(spark.createDataFrame([(w,) for w in words], "word string"), dictionary).collect()}
    known = {t for t, _ in terms}
    assert got == {w: b for w in words if w not in known and (b := brute(w, terms)) is not None}


# Retrieval


VECTORS = [(1, [1.0, 0.0, 0.0]), (2, [0.99, 0.14, 0.0]), (3, [0.98, 0.0, 0.2]), (4, [0.6, 0.8, 0.0]), (5, [0.0, 0.0, 1.0])]


def index(spark):
    return spark.createDataFrame(VECTORS, "doc_id bigint, embedding array<float>")


def asked(spark, *vectors):
    return spark.createDataFrame([(i, list(v)) for i, v in enumerate(vectors)], "query_id int, embedding array<float>")


def test_semantic_equals_brute_force_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    points, wanted = rng.normal(size=(200, 4)), rng.normal(size=(10, 4))
    idx = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "doc_id bigint, embedding array<double>")
    got = retrieval.semantic(asked(spark, *wanted.tolist()).withColumn("embedding", F.col("embedding").cast("array<double>")), idx.repartition(5), 7)
    found = {}
    for q, r, d, _ in rows(got):
        found.setdefault(q, {})[r] = d
    for q, w in enumerate(wanted.astype(np.float32).astype(float)):
        best = np.argsort(((points - w) ** 2).sum(axis=1), kind="stable")[:7]
        assert [found[q][r] for r in range(1, 8)] == best.tolist()


def test_diverse(spark):
    q = asked(spark, [1.0, 0.1, 0.0])
    plain = [r["doc_id"] for r in retrieval.semantic(q, index(spark), 3).orderBy("rank").collect()]
    even = [r["doc_id"] for r in retrieval.diverse(q, index(spark), 3, balance=1.0).orderBy("rank").collect()]
    mixed = [r["doc_id"] for r in retrieval.diverse(q, index(spark), 3, balance=0.3).orderBy("rank").collect()]
    assert plain == even and mixed[0] == plain[0] and mixed != plain


def test_filtered(spark):
    idx = index(spark).withColumn("lang", F.when(F.col("doc_id") > 2, "en").otherwise("fr")).withColumn("n", F.lit(1))
    got = retrieval.filtered(asked(spark, [1.0, 0.0, 0.0]), idx, {"lang": "en", "n": 1}, 2)
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == [3, 4]


def test_lexical_with_negative_idf(spark):
    docs = texts(spark, "the cat", "the dog", "the bird sings", "The cat cat", "fish")
    q = spark.createDataFrame([("a", "the cat"), ("b", "The")], "query_id string, text string")
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in retrieval.lexical(q, docs, 10).collect()}
    corpus = [t.split() for t in ("the cat", "the dog", "the bird sings", "The cat cat", "fish")]
    vocabulary = {w for d in corpus for w in d}
    n, mean = len(corpus), sum(map(len, corpus)) / len(corpus)
    raw = {w: math.log(n - sum(w in d for d in corpus) + 0.5) - math.log(sum(w in d for d in corpus) + 0.5) for w in vocabulary}
    idf = {w: v if v >= 0 else 0.25 * sum(raw.values()) / len(raw) for w, v in raw.items()}
    for query, words in (("a", ["the", "cat"]), ("b", ["The"])):
        for i, d in enumerate(corpus):
            if set(words) & set(d):
                score = sum(idf[w] * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / mean)) for w in words if w in d)
                assert got[(query, i)] == pytest.approx(score, abs=1e-5)
            else:
                assert (query, i) not in got


def test_fusion_and_pool(spark):
    one = spark.createDataFrame([(1, 1, 10, "x"), (1, 2, 11, "y")], "query_id int, rank int, doc_id bigint, text string")
    two = spark.createDataFrame([(1, 1, 11, "y"), (1, 2, 12, "z")], "query_id int, rank int, doc_id bigint, text string")
    got = rows(retrieval.fused([(one, 0.5), (two, 0.5)]).orderBy("rank").select("text", "score"))
    assert [g[0] for g in got] == ["y", "x", "z"] and got[0][1] == pytest.approx(0.5 / 62 + 0.5 / 61)
    lists = one.withColumn("list_no", F.lit(1)).unionByName(two.withColumn("list_no", F.lit(2)))
    assert {(r["text"], r["list_no"]) for r in retrieval.pooled(lists).collect()} == {("x", 1), ("y", 1), ("z", 2)}


def test_expanded_single_keeps_order(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i, _ in VECTORS], "doc_id bigint, text string")
    q = asked(spark, [0.0, 0.0, 1.0])
    single = q.withColumn("no", F.lit(1)).withColumn("embedding", F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0)]).cast("array<float>"))
    got = retrieval.expanded(q, single, index(spark), docs, 3)
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == [1, 2, 3]


def test_empty_rerank(spark):
    hits = spark.createDataFrame([], "query_id int, rank int, doc_id bigint")
    assert retrieval.reranked(hits, spark.createDataFrame([], "query_id int, doc_id bigint, score double")).count() == 0


def test_context_and_documents(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, "b", "positive", 3)], "doc_id bigint, text string, sentiment string, likes bigint")
    hits = df.select(F.lit(7).alias("query_id"), F.col("doc_id").cast("int").alias("rank"), "text", "sentiment", "likes")
    assert retrieval.context_blocks(hits).first()["context"] == "[1] (?, likes=0) a\n\n[2] (positive, likes=3) b"
    first = retrieval.comment_documents(df.withColumn("keywords", F.array(F.lit("x"), F.lit("y")))).orderBy("doc_id").first()
    assert first["meta"]["topic"] == -1 and first["meta"]["sentiment"] == "unknown" and first["meta"]["keywords"] == "x, y"


def test_retrieval_metrics(spark):
    hits = spark.createDataFrame([(1, 1, "no"), (1, 2, "Great Detail"), (2, 1, "zzz")], "query_id int, rank int, text string")
    gold = spark.createDataFrame([(1, ["detail"]), (2, ["x"])], "query_id int, expect array<string>")
    got = evaluate.retrieval_metrics(hits, gold).first()
    assert (got["hit_rate"], got["mrr"]) == (0.5, 0.25)


def test_answer_metrics_with_latency(spark):
    df = spark.createDataFrame([("a b [1]", 2.0), ("c", 4.0)], "text string, latency_s double")
    got = evaluate.answer_metrics(df).first()
    assert (got["avg_answer_words"], got["groundedness"], got["avg_latency_s"]) == (2.0, 0.5, 3.0)


# Chunks

LONG = "para one is here\n\n" + "word " * 120 + "\nline\n" + "x" * 700 + " end. Next one! Is it?"


def test_recursive_chunks(spark):
    got = rows(chunking.chunk(texts(spark, LONG, "", "short"), "recursive").orderBy("doc_id", "chunk_no"))
    assert all(0 < len(c) <= 250 for _, _, c in got)
    assert [c for d, _, c in got if d == 2] == ["short"] and not [c for d, _, c in got if d == 1]
    bare = "".join(c for _, _, c in rows(chunking.recursive_chunks(texts(spark, LONG), overlap=0).orderBy("chunk_no")))
    assert bare.replace(" ", "").replace("\n", "") == LONG.replace(" ", "").replace("\n", "")


def test_token_chunks(spark):
    words = [str(i) for i in range(205)]
    got = [c.split() for _, _, c in rows(chunking.chunk(texts(spark, " ".join(words), ""), "token").orderBy("chunk_no"))]
    assert got == [words[0:100], words[90:190], words[180:205]]


def test_semantic_chunks_and_switch(spark):
    same = " ".join(["red green blue."] * 10)
    got = [c for _, _, c in rows(chunking.chunk(texts(spark, same + " One two three."), "semantic").orderBy("chunk_no"))]
    assert got == [same, "One two three."]
    with pytest.raises(ValueError):
        chunking.chunk(texts(spark, "x"), "other")


# Joins, words, topics, models


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("weight", [None, "w"])
def test_salted_join_equals_plain_join(spark, how, weight):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    weighed = right.join(left.groupBy("k").agg(F.count("*").alias("w")), "k", "left").na.fill(0) if weight else right
    got = runtime.salted_join(left, weighed, "k", how, ["id"], weight)
    expected = left.join(right, "k", how)
    assert sorted(rows(got.select(*sorted(got.columns))), key=repr) == sorted(rows(expected.select(*sorted(expected.columns))), key=repr)


def test_large_lookup_takes_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(runtime.is_small, "__defaults__", (5,))
    df = texts(spark, "alpha beta gamma alpha", "beta delta alpha beta", "omega")
    large = {d: k for d, k in rows(keywords.keywords(df))}
    monkeypatch.setattr(runtime.is_small, "__defaults__", (200_000,))
    assert large == {d: k for d, k in rows(keywords.keywords(df))}


def test_collocations_reject_other_sizes(spark):
    with pytest.raises(ValueError):
        lexical.collocations(texts(spark, "a"), 4)


def test_spanning_trigrams_cross_short_comments(spark):
    df = texts(spark, "alpha", "", "beta", "gamma delta epsilon")
    got = {r["gram"] for r in lexical.top_ngrams(df, 3, span=True).collect()}
    assert got == {"alpha beta gamma", "beta gamma delta", "gamma delta epsilon"}


def test_distinctive_terms_need_two_groups(spark):
    df = texts(spark, "apple pie", "apple tart").withColumn("sentiment", F.lit("positive"))
    assert lexical.distinctive_terms(df).count() == 0


def test_longest_leftmost_entities(spark):
    gaz = runtime.fixed_table(
        spark,
        [("new york", "GPE", 0.9), ("new york city", "GPE", 0.9), ("york", "PERSON", 0.9), ("city hall", "ORG", 0.9), ("mall", "FAC", 0.9)],
        "phrase string, label string, score double",
    )
    got = entities.with_entities(texts(spark, "New York City Hall, york mall", "nothing"), gaz).orderBy("doc_id")
    assert [r["entity_labels"] for r in got.collect()] == [["New York City:GPE", "york:PERSON"], []]


def test_keywords_skip_near_duplicates(spark):
    df = texts(spark, "extraordinarily extraordinarilyy banana", "other thing", "")
    got = dict(rows(keywords.with_keywords(df).select("doc_id", "keywords")))
    assert not {"extraordinarily", "extraordinarilyy"} <= set(got[0]) and got[2] == []


def test_topics_are_renumbered_and_small_ones_dropped(spark):
    clustered = spark.createDataFrame([(i, 7 if i < 40 else 3 if i < 100 else 9) for i in range(105)], "doc_id bigint, cluster int")
    got = dict(rows(topics.renumbered(clustered, 30).groupBy("topic").count()))
    assert got == {0: 60, 1: 40, -1: 5}


def test_topic_fallback(spark):
    assert [r["topic"] for r in topics.with_topics(texts(spark, "a", None, "")).collect()] == [-1, -1, -1]


def test_stratified_split_is_exact_per_label(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 900, "a").otherwise("b").alias("label"))
    got = {(r["label"], r["part"]): r["count"] for r in classify.stratified_split(df).groupBy("label", "part").count().collect()}
    assert got == {("a", "test"): 180, ("a", "train"): 720, ("b", "test"): 20, ("b", "train"): 80}


def test_classifier_learns_and_predicts(spark):
    data = [(i, f"lovely sunny picnic number{i}" if i % 2 else f"awful broken mess number{i}", "good" if i % 2 else "bad") for i in range(60)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, label string")
    model, table = classify.train(df, iterations=20)
    scores = {r["name"]: r["f1"] for r in table.collect()}
    assert scores["accuracy"] > 0.9
    got = lexicon.with_sentiment(texts(spark, "sunny picnic", "broken mess"), "model", model=model).orderBy("doc_id").collect()
    assert [r["sentiment"] for r in got] == ["good", "bad"] and all(0.5 <= r["sentiment_score"] <= 1 for r in got)


def test_tuning_with_a_label_missing_from_folds(spark):
    data = [(i, f"lovely picnic n{i}" if i % 2 else f"awful mess n{i}", "good" if i % 2 else "bad") for i in range(40)]
    data += [(40, "odd one", "rare"), (41, "odd two", "rare")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, label string")
    model, table = classify.train(df, tune=True, draws=1, folds=2, iterations=5)
    assert {"good", "bad", "rare"} <= {r["name"] for r in table.collect()}
    assert model.stages[0].labels == ["bad", "good", "rare"]


def test_every_term_is_a_feature(spark):
    data = [(i, " ".join(f"w{i}x{j}" for j in range(2500)), "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, label string")
    model, _ = classify.train(df, iterations=1)
    assert len(model.stages[1].vocabulary) == 32 * (2500 + 2499)


def test_routing(spark):
    df = spark.createDataFrame([("Sentiment!",), (" the topics",), ("unclear",), (None,), ("summary of topics",)], "text string")
    assert [tuple(r)[1:] for r in report.routed(df).collect()] == [
        ("sentiment", "sentiment_agent"), ("topics", "topic_agent"), ("qa", "qa_agent"), ("qa", "qa_agent"), ("summary", "summary_agent"),
    ]


def test_topic_insight_without_topics(spark):
    assert report.topic_insight(texts(spark, "a")).first()["line"] == "Topic modeling has not been run yet."


def test_enrich_with_spelling(spark):
    raw = spark.createDataFrame(
        [(0, "v", "helo <b>New York</b>"), (1, "v", "bad thing"), (2, "v", "bad  thing"), (3, "v", "x")],
        "doc_id bigint, video_id string, text string",
    )
    gaz = runtime.fixed_table(spark, [("new york", "GPE", 0.9)], "phrase string, label string, score double")
    lex = runtime.fixed_table(spark, [("bad", -2.5)], "word string, valence double")
    words = runtime.fixed_table(spark, [("hello", 5)], "term string, freq bigint")
    got = enrich(raw, gaz, lex, dictionary=words).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["hello New York", "bad thing"]
    assert [r["comment_id"] for r in got] == ["c000000", "c000001"]
    assert got[0]["entity_labels"] == ["New York:GPE"] and got[1]["sentiment"] == "negative"
    assert [r["topic"] for r in got] == [-1, -1] and "hello" in got[0]["keywords"]


def test_corrected_copies_are_removed_before_numbering(spark):
    raw = spark.createDataFrame([(0, "helo world"), (1, "hello world"), (2, "hello you")], "doc_id bigint, text string")
    words = runtime.fixed_table(spark, [("hello", 5), ("world", 5), ("you", 5)], "term string, freq bigint")
    got = clean.clean_comments(raw, correct=lambda df: spelling.correct_text(df, words)).orderBy("doc_id").collect()
    assert [(r["comment_id"], r["text"]) for r in got] == [("c000000", "hello world"), ("c000001", "hello you")]


def test_lemmas_of_ngrams(spark):
    df = texts(spark, "red cars stop", "red car stops", "red car stop")
    lemmas = spark.createDataFrame([("cars", "car"), ("stops", "stop")], "word string, lemma string")
    assert dict(rows(lexical.top_ngrams(df, 2, lemmas=lemmas))) == {"red car": 3, "car stop": 3}
    got = {r["gram"]: (r["freq"], r["pmi"]) for r in lexical.collocations(df, 2, lemmas=lemmas).collect()}
    assert got == {"red car": (3, round(math.log2(3), 9)), "car stop": (3, round(math.log2(3), 9))}


def test_lemma_arrays_by_lookup_and_by_join(spark, monkeypatch):
    df = texts(spark, "red cars stop cars", "cars", "", None)
    lemmas = spark.createDataFrame([("cars", "car"), ("stops", "stop")], "word string, lemma string")
    want = [(0, ["red", "car", "stop", "car"]), (1, ["car"]), (2, []), (3, lexical.token_arrays(df).orderBy("doc_id").collect()[3]["tokens"])]
    assert sorted(map(tuple, lexical.lemma_arrays(df, lemmas).collect())) == want
    monkeypatch.setattr(lexical, "is_small", lambda table: False)
    assert sorted(map(tuple, lexical.lemma_arrays(df, lemmas).collect())) == want


def test_stream_keeps_columns_and_replaces_a_repeated_batch(spark, tmp_path):
    def arrive(*data):
        spark.createDataFrame(data, "doc_id bigint, text string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("doc_id bigint, text string").parquet(str(tmp_path / "in"))
        ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "state"), "doc_id").awaitTermination()

    def stored():
        return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive((2, "same  text"), (1, "same text"), (3, None), (4, ""))
    arrive((5, "same text"), (6, "new text"))
    assert stored() == [(1, "same text"), (6, "new text")]
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    arrive((7, "third text"))
    assert stored() == [(1, "same text"), (6, "new text"), (7, "third text")]


def test_stream_looks_up_its_own_keys_only(spark, tmp_path):
    def arrive(texts):
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("doc_id bigint, text string").parquet(str(tmp_path / "in"))
        query = ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "state"), "doc_id")
        query.awaitTermination()
        state = [p for p in query.recentProgress if p.stateOperators][-1].stateOperators[0]
        return state.numRowsTotal, int(state.customMetrics["rocksdbGetCount"])

    assert arrive([f"text {'x'.join(str(i))}" for i in range(3000)])[0] == 3000
    # Most are copies of one another, one is old: keys are looked up, not the history.
    total, looked_up = arrive([f"text {'x'.join(str(2990 + i % 20))}" for i in range(400)])
    assert total == 3010 and looked_up <= 100
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == stored.select("text").distinct().count() == 3010


def test_stream_equals_batch(spark, tmp_path):
    for i, batch in enumerate([["alpha one", "beta two"], ["alpha one", "x", "gamma   three"]]):
        spark.createDataFrame([(t,) for t in batch], "text string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
        ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["alpha one", "beta two", "gamma three"]

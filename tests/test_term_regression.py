"""The classifier whose terms stay on the executors, against MLlib's, which holds them on the driver."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.operators import classify, term_regression
from murmuro.operators.lexical import uni_and_bigrams


def data(spark, classes):
    rng = random.Random(classes)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words[: 20 + 20 * (i % classes)], k=rng.randint(0, 30))), "abc"[i % classes]) for i in range(60)]
    # Copies, a text without words, and none.
    rows += [(60, rows[3][1], "a"), (61, rows[3][1], "b"), (62, "", "a"), (63, None, "b")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


@pytest.mark.parametrize(("classes", "iterations"), [(2, 3), (2, 100), (3, 5)])
def test_scores_are_those_of_mllib(spark, classes, iterations):
    df = data(spark, classes)
    model, _ = classify.train(df, iterations=iterations)
    split = classify.stratified_split(df)
    terms = classify.features(split).withColumn("terms", uni_and_bigrams(F.col("words"))).cache()
    training = terms.where("part = 'train'")
    plain = Pipeline(stages=[
        StringIndexer(inputCol="label", outputCol="label_no", stringOrderType="alphabetAsc"),
        CountVectorizer(inputCol="terms", outputCol="tf"),
        IDF(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="unit"),
        LogisticRegression(featuresCol="unit", labelCol="label_no", maxIter=iterations, regParam=1 / training.count()),
    ]).fit(training)
    expected = plain.transform(terms).select("doc_id", F.array_max(vector_to_array("probability")), "prediction").collect()
    got = {r.doc_id: r for r in classify.predict(model, df).collect()}
    for doc_id, score, label in expected:
        assert got[doc_id].prediction_score == pytest.approx(score, abs=1e-6)
        assert got[doc_id].prediction_label == "abc"[int(label)]


def test_weights_are_a_table_and_terms_alike_are_one_pattern(spark):
    df = spark.createDataFrame([(i, f"shared only{i} once{i}", "ab"[i % 2]) for i in range(10)], "doc_id bigint, text string, label string")
    model, _ = classify.train(df, iterations=2)
    assert isinstance(model.stages[1].weights, DataFrame)
    assert set(model.stages[1]) >= {"shared"} and len(model.stages[1].vocabulary) == 1 + 4 * 8
    rows = term_regression.numbered_rows(classify.features(df), "rows")
    found = term_regression.patterns(term_regression.term_lists(rows)).collect()
    # The shared word, and for each row its four other terms together.
    assert sorted(np.concatenate([np.frombuffer(r.times, np.int32) for r in found])) == [1] + [4] * 10


def test_rows_of_a_term_in_several_batches_are_joined(monkeypatch):
    monkeypatch.setattr(term_regression, "BLOCK", 4)
    monkeypatch.setattr(term_regression, "LISTS", 2)

    def batch(*rows):
        lists = [[np.array(x, np.int32).tobytes() for x in column] for column in zip(*[r[1:] for r in rows], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), *(pa.array(x, pa.binary()) for x in lists)], ["term", "rows", "uses"])

    batches = [batch(("a", [5], [1]), ("a", [3, 1], [2, 7]), ("b", [2], [1])), batch(("b", [0], [9]), ("b", [4, 7], [1, 1])), batch(("c", [1], [3]))]
    out = [row for b in term_regression._joined(iter(batches)) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    got = [(t, np.frombuffer(r, np.int32).tolist(), np.frombuffer(u, np.int32).tolist()) for t, r, u in out]
    assert got == [("a", [1, 3, 5], [7, 2, 1]), ("b", [0, 2, 4, 7], [9, 1, 1, 1]), ("c", [1], [3])]

"""Text classification: split, train, tune, predict.

The regression is `term_regression`, not MLlib's: MLlib keeps vocabulary and weights of all terms on the driver.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuro.functions import tokens
from murmuro.operators import term_regression
from murmuro.operators.browse import seeded
from murmuro.operators.evaluate import classification_report
from murmuro.runtime import lookup_join, n_rows, written

# Ranges of the seeded order in which rows of one label are ranked side by side.
SPLIT_RANGES = 16


def stratified_split(
    df: DataFrame, label: str = "label", test_share: float = 0.2, order_key: str = "doc_id", seed: int = 42
) -> DataFrame:
    """Add `part`: in every label the first `test_share` of its rows in seeded order is `test`, the rest `train`.

    Rows are ranked in two steps, by range of the seeded number and inside the range, so
    one label holding most rows is still ranked by many tasks.
    """
    number = seeded(order_key, seed)
    keyed = df.withColumn("_n", number).withColumn("_range", F.shiftright("_n", 48 - SPLIT_RANGES).cast("int"))
    per_range = keyed.groupBy(label, "_range").agg(n_rows("_rows"))
    # At most 2^16 rows per label.
    earlier = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        label,
        "_range",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(label)).alias("_all"),
    )
    inside = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_n", order_key))
    ranked = lookup_join(keyed, written(starts, "split-ranges"), [label, "_range"]).withColumn("_rank", F.col("_start") + inside)
    in_test = F.col("_rank") <= F.ceil(F.col("_all") * test_share)
    return ranked.withColumn("part", F.when(in_test, "test").otherwise("train")).drop("_n", "_range", "_start", "_all", "_rank")


def features(df: DataFrame) -> DataFrame:
    """Attach `words`, without stop words; these and the pairs of neighbours are the terms."""
    return df.withColumn("words", tokens.feature_tokens(F.coalesce("text", F.lit(""))))


@dataclass
class Vocabulary:
    """The model's terms and weights: (term, df, idf, weight per margin), a table."""

    weights: DataFrame

    @property
    def vocabulary(self) -> Vocabulary:
        return self

    def __len__(self) -> int:
        return self.weights.count()

    def __iter__(self) -> Iterator[str]:
        return (r.term for r in self.weights.select("term").toLocalIterator())


@dataclass
class Intercepts:
    values: np.ndarray


@dataclass
class TextModel:
    """A fitted classifier: labels in and out, terms and their weights, intercepts."""

    stages: tuple[StringIndexerModel, Vocabulary, Intercepts]


def random_settings(rows: int, draws: int, seed: int) -> list[dict]:
    """Random draws: max document share in [0.7, 1], min documents 1, 2 or 5, C in [0.1, 10.1]."""
    rng = random.Random(seed)
    return [
        {
            "most_share": rng.uniform(0.7, 1.0),
            "least": float(rng.choice([1, 2, 5])),
            "penalty": 1.0 / (rng.uniform(0.1, 10.1) * rows),
        }
        for _ in range(draws)
    ]


def setting_for(drawn: dict, rows: int) -> term_regression.Setting:
    """The draw for so many training rows; a share of 1 or more sets no limit but one row, as in `CountVectorizer`."""
    share = drawn["most_share"]
    return term_regression.Setting(drawn["penalty"], drawn["least"], share * rows if share < 1 else share)


def best_draw(
    blocks: DataFrame, labels: np.ndarray, classes: int, places: np.ndarray, drawn: list[dict], folds: int, iterations: int
) -> dict:
    """The draw of the highest mean accuracy over the folds, the first one of several; a fold is a range of `places` in [0, 1)."""
    accuracy = np.zeros((folds, len(drawn)))
    for fold in range(folds):
        held_out = (places >= fold / folds) & (places < (fold + 1) / folds)
        settings = [setting_for(d, int((~held_out).sum())) for d in drawn]
        for i, fit in enumerate(term_regression.fitted(blocks, labels, classes, ~held_out, settings, iterations)):
            margins = fit.margins[held_out]
            guessed = margins.argmax(axis=1) if classes > 2 else margins[:, 0] > 0
            accuracy[fold, i] = np.mean(guessed == labels[held_out])
    return drawn[int(np.argmax(accuracy.mean(axis=0)))]


def train(
    df: DataFrame,
    tune: bool = False,
    draws: int = 10,
    folds: int = 3,
    test_share: float = 0.2,
    iterations: int = 1000,
    seed: int = 42,
    order_key: str = "doc_id",
) -> tuple[TextModel, DataFrame]:
    """Fit on the training part of (order key, text, label); returns the model and its test report.

    TF-IDF of all terms at unit length, then logistic regression with the penalty of one row at C = 1. The driver holds
    each training row's number, label and fold, not its terms. The label numbers come from both parts and are the same
    in all folds.
    """
    split = written(
        stratified_split(df.withColumn("label", F.col("label").cast("string")), "label", test_share, order_key, seed),
        "split",
    )
    labels = StringIndexer(inputCol="label", outputCol="label_no", stringOrderType="alphabetAsc").fit(split)
    indexed = labels.transform(split)
    training, test = indexed.where("part = 'train'"), indexed.where("part = 'test'")
    training = term_regression.numbered_rows(training.select("text", "label_no", F.rand(seed).alias("place")), "training")
    numbers = training.select("row", F.col("label_no").cast("int").alias("label_no"), "place").toArrow().sort_by("row")
    known, places = numbers["label_no"].to_numpy(), numbers["place"].to_numpy()
    rows, classes = len(known), len(labels.labels)
    lists = term_regression.term_lists(features(training))
    blocks = term_regression.patterns(lists)
    if tune:
        drawn = best_draw(blocks, known, classes, places, random_settings(rows, draws, seed), folds, iterations)
        setting = setting_for(drawn, rows)
    else:
        setting = term_regression.Setting(1.0 / max(rows, 1))
    (fit,) = term_regression.fitted(blocks, known, classes, np.ones(rows, bool), [setting], iterations)
    model = TextModel((labels, Vocabulary(term_regression.weights(lists, fit)), Intercepts(fit.intercepts)))
    tested = predict(model, test.select("label", "text"))
    return model, classification_report(tested, "label", "prediction_label")


def predict(model: TextModel, df: DataFrame) -> DataFrame:
    """Attach `prediction_label` and `prediction_score`, the largest class probability.

    Terms meet their weights in a join. A text without any known term has the intercepts alone.
    """
    labels, terms, intercepts = model.stages
    columns = range(len(intercepts.values))
    placed = term_regression.numbered_rows(df, "to-predict")
    found = term_regression.sums_of_weights(features(placed.select("row", "text")), terms.weights, len(columns))
    # A text of terms that all rows have is of no length.
    margins = [
        F.coalesce(F.try_divide(f"s{i}", "length"), F.lit(0.0)) + F.lit(float(intercepts.values[i])) for i in columns
    ]
    likely = placed.join(found.hint("merge"), "row", "left").withColumn("_margins", F.array(*margins))
    likely = likely.withColumn("_likely", term_regression.probabilities(F.col("_margins"), len(columns)))
    score = F.array_max("_likely")
    if len(columns) > 1:
        best = F.array_position("_margins", F.array_max("_margins")).cast("int") - 1
    else:
        best = (F.col("_margins")[0] > 0).cast("int")
    names = F.array(*[F.lit(name) for name in labels.labels])
    return likely.select(*df.columns, F.get(names, best).alias("prediction_label"), score.alias("prediction_score"))

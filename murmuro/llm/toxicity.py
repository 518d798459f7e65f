"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each model sees the text's features and the probabilities of
the categories before it. While training, those probabilities come from models that have not seen the
document (out of fold), so later models learn from probabilities as good as the ones they will get.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuro.llm.words import WORD, free_name, pieces, remembering, text_or_empty
from murmuro.runtime import written

# Hashed features: words and the first letters of longer ones, so that one weight stands for a stem's endings.
BITS, STEMS = 18, (4, 5, 6)
FOLDS = 3
# The models are fitted on so many labelled documents at most, chosen by a hash of their id, and on so
# many features of them in all. Scoring covers every document and its whole text.
SAMPLE, SAMPLE_FEATURES = 8_000, 12_000_000
# Rejecting chance where the sample has too few documents of the deciding category to choose one.
THRESHOLD, LEAST_POSITIVE = 0.5, 5
STEPS, REGULARISATION = 60, 1e-6
# Words whose features a worker remembers.
REMEMBERED = 150_000

# The chain over the label columns at hand: general quality first, then toxicity, then toxicity in good text.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"), ("toxic_prose", "toxic = 1 AND quality = 1"))
DECIDES = "toxic"


class Chain(NamedTuple):
    """One weight vector per category, and the chance of the deciding one from which on a text is rejected."""

    weights: list[np.ndarray]
    threshold: float


class _Places(dict):
    """Word to its row in a growing table of feature numbers; short words leave later columns unused."""

    def __init__(self) -> None:
        self.table = np.empty((1 << 12, 1 + len(STEMS)), np.int32)

    def __missing__(self, word: str) -> int:
        parts = [word] + [f"{n}^{word[:n]}" for n in STEMS if len(word) > n]
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[row] = -1
        self.table[row, : len(parts)] = [xxhash.xxh32_intdigest(p) >> (32 - BITS) for p in parts]
        self[word] = row
        return row


_PLACES = _Places()


def _forget_places() -> None:
    global _PLACES
    _PLACES = _Places()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, values) of a text's features: counts scaled to length 1, numbers rising and distinct."""
    remembering(_forget_places)
    if len(_PLACES) > REMEMBERED:
        _forget_places()
    rows = []
    for piece in pieces(text.lower()):
        words = WORD.findall(piece)
        rows.append(np.fromiter(map(_PLACES.__getitem__, words), np.int64, len(words)))
    words, times = np.unique(np.concatenate(rows), return_counts=True)
    numbers = _PLACES.table[words]
    used = numbers >= 0
    # Sorting the few features of a text costs less than counting into an array as wide as all features.
    numbers, place = np.unique(numbers[used], return_inverse=True)
    values = np.bincount(place, np.broadcast_to(times[:, None], used.shape)[used], len(numbers))
    return numbers.astype(np.int32), (values / max(np.sqrt((values**2).sum()), 1e-9)).astype(np.float32)


class Examples:
    """Sparse rows: features of the text, then one dense column per earlier category."""

    def __init__(self, numbers: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        self.numbers, self.values, self.sizes = numbers, values, sizes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)

    def take(self, rows: np.ndarray) -> Examples:
        keep = rows[self.owner]
        return Examples(self.numbers[keep], self.values[keep], self.sizes[rows])

    def product(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.values * weights[self.numbers], len(self.sizes))

    def transposed(self, errors: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.numbers, self.values * errors[self.owner], width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fitted(x: Examples, earlier: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Weights of a logistic regression: `width` features, the earlier categories, the intercept.

    Features are scaled by the logarithm of how much more frequent they are inside the category, so a
    telling word weighs more than a rare one. Minimised by limited-memory quasi-Newton steps. A category that
    never or always occurs keeps an intercept only.
    """
    n = max(len(y), 1)
    inside = np.bincount(x.numbers, y[x.owner], width)
    outside = np.bincount(x.numbers, minlength=width) - inside
    ratio = np.log((inside + 1) / (y.sum() + 2)) - np.log((outside + 1) / (n - y.sum() + 2))
    x = Examples(x.numbers, x.values * ratio[x.numbers], x.sizes)
    out = np.zeros(width + earlier.shape[1] + 1)
    share = float(y.mean()) if len(y) else 0.0
    out[-1] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if share in (0.0, 1.0):
        return out

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        score = x.product(w[:width]) + earlier @ w[width:-1] + w[-1]
        wrong = (sigmoid(score) - y) / n
        slope = np.concatenate([x.transposed(wrong, width), earlier.T @ wrong, [wrong.sum()]])
        penalty = REGULARISATION * w
        penalty[-1] = 0
        value = np.logaddexp(0, np.where(y > 0, -score, score)).sum() / n + (penalty * w).sum() / 2
        return float(value), slope + penalty

    value, slope = loss(out)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        step, used = slope.copy(), []
        for s, g, r in reversed(past):
            a = r * (s @ step)
            used.append(a)
            step -= a * g
        if past:
            s, g, _ = past[-1]
            step *= (s @ g) / (g @ g)
        for (s, g, r), a in zip(past, reversed(used), strict=True):
            step += (a - r * (g @ step)) * s
        length = 1.0 if past else 1 / max(np.abs(slope).sum(), 1e-9)
        for _ in range(20):
            new = out - length * step
            new_value, new_slope = loss(new)
            if new_value <= value - 1e-4 * length * (slope @ step):
                break
            length /= 2
        else:
            break
        s, g = new - out, new_slope - slope
        if s @ g > 1e-12:
            past = [*past[-9:], (s, g, 1 / (s @ g))]
        gain, out, value, slope = value - new_value, new, new_value, new_slope
        if gain < 1e-7:
            break
    out[:width] *= ratio
    return out


def best_threshold(chance: np.ndarray, y: np.ndarray) -> float:
    """The chance that parts the documents with the best F0.5, which weighs false alarms more, halfway (in odds) to the next one below."""
    if y.sum() < LEAST_POSITIVE:
        return THRESHOLD
    order = np.argsort(-chance, kind="stable")
    odds = np.log(np.clip(chance[order], 1e-12, 1 - 1e-12) / (1 - np.clip(chance[order], 1e-12, 1 - 1e-12)))
    hits = np.cumsum(y[order])
    f = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    f[:-1][odds[:-1] == odds[1:]] = 0  # equal chances are not parted
    k = int(np.argmax(f))
    return float(sigmoid((odds[k] + odds[min(k + 1, len(y) - 1)]) / 2))


def chained(x: Examples, y: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Weights of each category's model, later ones trained with out-of-fold probabilities of the earlier; these too.

    Features of a single document cannot help another one and are left out.
    """
    used = np.flatnonzero(np.bincount(x.numbers, minlength=1 << BITS) > 1)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    numbers = place[x.numbers]
    keep, width = numbers >= 0, len(used)
    x = Examples(numbers[keep], x.values[keep], np.bincount(x.owner[keep], minlength=len(x.sizes)))
    earlier, out = np.empty((len(fold), 0)), []
    for k in range(y.shape[1]):
        w = fitted(x, earlier, y[:, k], width)
        out.append(np.zeros((1 << BITS) + k + 1))
        out[-1][used], out[-1][1 << BITS :] = w[:width], w[width:]
        if k + 1 == y.shape[1]:
            break
        chance = np.empty(len(fold))
        for f in range(FOLDS):
            seen, held = fold != f, fold == f
            w = fitted(x.take(seen), earlier[seen], y[seen, k], width)
            part = x.take(held)
            chance[held] = sigmoid(part.product(w[:width]) + earlier[held] @ w[width:-1] + w[-1])
        earlier = np.column_stack([earlier, chance])
    return out, earlier


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most `sample` labelled documents; its threshold follows from out-of-fold probabilities.

    The sample's features are gathered in one task, whose input is bounded by SAMPLE_FEATURES. Labels
    without a document, documents without a label and rows without a doc_id take no part; of several
    labels or documents of one id one counts. A missing text is empty, a missing label counts as not
    in the category. Without any labelled document the models say 0 for everything.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(*[F.max(F.coalesce(F.expr(rule), F.lit(False)).cast("int")).alias(n) for n, rule in categories])
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().join(known, "doc_id")
    # Ids are chosen before any text is touched; their number is bounded by `sample`, so they may travel.
    ids = written(ids.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(sample), "labelled")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    y = F.array(*[F.col(n) for n, _ in categories]).alias("y")
    rows = texts.join(F.broadcast(ids.select("doc_id", y)), "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            numbers = pa.array([f[0] for f in found], pa.list_(pa.int32()))
            values = pa.array([f[1] for f in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), numbers, values], ["doc_id", "y", "numbers", "values"]
            )

    described = rows.mapInArrow(describe, "doc_id bigint, y array<int>, numbers array<int>, values array<float>")
    described = written(described, "features")
    # In the order of a hash, so the files' order decides nothing; at most `sample` ids and their sizes in one task.
    place = Window.orderBy(F.xxhash64(F.lit(2), "doc_id"), "doc_id", F.size("numbers")).rowsBetween(Window.unboundedPreceding, 0)
    taken = described.select("doc_id", F.sum(F.size("numbers")).over(place).alias("upto")).where(F.col("upto") <= SAMPLE_FEATURES)
    described = described.join(F.broadcast(taken.select("doc_id").distinct()), "doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {}
        for batch in batches:
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                numbers, values = (batch.column(c)[i].values.to_numpy() for c in ("numbers", "values"))
                here = (batch.column("y")[i].as_py(), numbers, values)
                # Of several documents of one id the one with the fewest features, then the least of them.
                if doc_id not in parts or (len(numbers), numbers.tobytes()) < (len(parts[doc_id][1]), parts[doc_id][1].tobytes()):
                    parts[doc_id] = here
        order = sorted(parts)
        got = [parts[i] for i in order]
        y = np.asarray([g[0] for g in got], float).reshape(len(got), len(categories))
        sizes = np.asarray([len(g[1]) for g in got], np.int64)
        numbers = np.concatenate([g[1] for g in got]) if got else np.empty(0, np.int32)
        values = np.concatenate([g[2] for g in got]) if got else np.empty(0, np.float32)
        fold = np.asarray([xxhash.xxh32_intdigest(str(i)) % FOLDS for i in order], np.int64)
        weights, chances = chained(Examples(numbers, values, sizes), y, fold)
        decides = [n for n, _ in categories].index(DECIDES)
        threshold = best_threshold(chances[:, decides], y[:, decides]) if got else THRESHOLD
        for k, w in enumerate(weights):
            at = np.flatnonzero(w)
            at = np.union1d(at, [len(w) - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([len(w)]), pa.array([at], pa.list_(pa.int64())), pa.array([w[at]], pa.list_(pa.float64()))]
                + [pa.array([threshold])],
                ["k", "width", "at", "weight", "threshold"],
            )

    models = described.coalesce(1).mapInArrow(learn, "k bigint, width bigint, at array<bigint>, weight array<double>, threshold double")
    out, threshold = [], THRESHOLD
    # One row per category, with at most one weight per hashed feature.
    for r in sorted(models.collect(), key=lambda r: r.k):
        w = np.zeros(r.width)
        w[r.at] = r.weight
        out.append(w)
        threshold = r.threshold
    if not out:
        out = [np.zeros((1 << BITS) + k + 1) for k in range(len(categories))]
        for w in out:
            w[-1] = -35.0
    return Chain(out, threshold)


def scored(df: DataFrame, chain: Chain, text: str, name: str) -> DataFrame:
    """Adds `name`, the probabilities of all categories in chain order, and takes `text` away."""
    shared = df.sparkSession.sparkContext.broadcast(chain.weights)
    others = df.drop(text)
    names = others.columns
    schema = others.select("*", F.array().cast("array<double>").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.stack([w[: 1 << BITS] for w in shared.value], 1)
        rest = [w[1 << BITS :] for w in shared.value]
        for batch in batches:
            out = []
            for t in batch.column(text):
                numbers, values = features(t.as_py())
                base = values @ weights[numbers] if len(numbers) else np.zeros(len(rest))
                chances: list[float] = []
                for k, w in enumerate(rest):
                    chances.append(float(sigmoid(base[k] + np.dot(chances, w[:-1]) + w[-1])))
                out.append(chances)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.list_(pa.float64()))], [*names, name])

    return df.mapInArrow(run, schema)


def scores(docs: DataFrame, chain: Chain, categories=CATEGORIES) -> DataFrame:
    """(doc_id, p_<category> ..., toxic) of every document: `toxic` where the deciding category reaches the chain's threshold.

    A missing text is empty, and an empty one is scored by the models' intercepts alone. Rows without a
    doc_id are scored too, repeated rows each give a row, other columns are left out. No rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    out = scored(texts, chain, "text", "p")
    chances = [F.col("p")[i].alias(f"p_{n}") for i, (n, _) in enumerate(categories)]
    return out.select("doc_id", *chances).withColumn("toxic", F.col(f"p_{DECIDES}") >= chain.threshold)


def accepted(docs: DataFrame, chain: Chain, categories=CATEGORIES) -> DataFrame:
    """The rows of `docs`, all columns, that are not toxic."""
    text = free_name(docs.columns, "text")
    chances = free_name([*docs.columns, text], "chances")
    place = [n for n, _ in categories].index(DECIDES)
    out = scored(docs.withColumn(text, text_or_empty()), chain, text, chances)
    return out.where(F.col(chances)[place] < chain.threshold).drop(chances)

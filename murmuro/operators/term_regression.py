"""Logistic regression over every term of a corpus, with neither the terms nor their weights on the driver.

The weights of least penalised loss are a sum of training rows, each times a coefficient. So the search for them (limited
memory BFGS) walks among coefficients: the driver holds numbers per training row and class, some forty of each, however
many terms the texts have. Of the texts it asks one thing a step, the product of the rows' inner products with a vector
of coefficients: every task makes the weights of its own terms and adds up what they give to each row.

A row is TF-IDF at length one, terms are divided by their deviation and centred, the penalty is on such terms' weights.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from murmuro.functions import tokens
from murmuro.runtime import lookup_join, n_rows, written

# Entries (term, row) and lists of them that are held together; a term's own entries are never parted.
BLOCK, LISTS = 1 << 16, 1_024
# Steps that the search remembers, share of the first loss that ends it, losses among which it must show.
REMEMBERED, TOLERANCE, LOSSES = 10, 1e-6, 20
# Numbers that searches side by side may hold on the driver, 256 MB of them.
HELD = 1 << 25

Search = Generator[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]


def numbered_rows(df: DataFrame, label: str) -> DataFrame:
    """Add `row`: numbers from 0 without gaps, the same at every reading."""
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()), label)
    # The upper bits are the task's number, the lower 33 the place among its rows.
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task.
    starts = placed.groupBy("_task").agg(n_rows("_rows")).select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    row = (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int")
    return placed.join(F.broadcast(starts), "_task").withColumn("row", row).drop("_at", "_task", "_start")


def term_uses(rows: DataFrame) -> DataFrame:
    """(term, rows, uses) of (row, words): words and word pairs, the rows of some lists that have it, how often each does."""
    return rows.select("row", "words").mapInArrow(_term_uses, "term string, rows binary, uses binary")


def _term_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, tokens.TEXTS):
            batch = whole.slice(at, tokens.TEXTS)
            places = batch.column(0).to_numpy()
            for owner, number, uses, names in tokens.list_terms(batch.column(1)):
                order = np.argsort(number, kind="stable")
                ends = np.cumsum(np.bincount(number, minlength=len(names)))
                columns = [names] + [_lists(numbers[order], ends) for numbers in (places[owner], uses)]
                yield pa.RecordBatch.from_arrays(columns, ["term", "rows", "uses"])


def _lists(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Numbers of four bytes, one string of bytes up to each end."""
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(numbers.astype(np.int32))])


def _numbers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of such strings, and how many each has."""
    if not len(lists):
        return np.empty(0, np.int32), np.empty(0, np.int32)
    offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
    start, end = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(lists.buffers()[2].slice(start, end - start).to_pybytes(), np.int32), np.diff(offsets) // 4


def term_lists(rows: DataFrame) -> DataFrame:
    """(term, rows, uses) of (row, words), one row per term, its rows ascending."""
    uses = term_uses(rows).repartition("term").sortWithinPartitions("term")
    return written(uses.mapInArrow(_joined, "term string, rows binary, uses binary"), "term-lists")


def _entries(batch: pa.RecordBatch) -> int:
    return int(pc.sum(pc.binary_length(batch.column("rows"))).as_py() or 0) // 4


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, most = [], 0, BLOCK
    for batch in batches:
        # Frequent terms bring many rows each.
        for at in range(0, batch.num_rows, LISTS):
            held.append(batch.slice(at, LISTS))
            size += _entries(held[-1])
            if size >= most:
                found, rest = _cut(held, whole=False)
                yield from found
                held, size = [rest], _entries(rest)
                most = size + BLOCK
    if size:
        yield from _cut(held, whole=True)[0]


def _cut(held: list[pa.RecordBatch], whole: bool) -> tuple[list[pa.RecordBatch], pa.RecordBatch]:
    """Each term once, and the rows that stay: unless these are the whole rest, the last term's."""
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    runs = pc.run_end_encode(rows.column("term"))
    ends = runs.run_ends.to_numpy()
    n = len(ends) if whole else len(ends) - 1
    if not n:
        return [], rows
    cut = rows.slice(0, int(ends[n - 1]))
    numbers, sizes = _numbers(cut.column("rows"))
    lens = np.add.reduceat(sizes, np.concatenate([[0], ends[: n - 1]]))
    order = np.lexsort((numbers, np.repeat(np.arange(n), lens)))
    lists = [_lists(all_of[order], np.cumsum(lens)) for all_of in (numbers, _numbers(cut.column("uses"))[0])]
    return [pa.RecordBatch.from_arrays([runs.values.slice(0, n), *lists], ["term", "rows", "uses"])], rows.slice(cut.num_rows)


def patterns(lists: DataFrame) -> DataFrame:
    """Blocks of distinct (rows, uses), and how many terms have each: such terms always have the same weight.

    Most terms stand in one row only, and those of rows that are copies in the same rows.
    """
    distinct = lists.groupBy("rows", "uses").agg(F.count(F.lit(1)).alias("times"))
    return written(distinct.mapInArrow(_packed, "lens binary, rows binary, uses binary, times binary"), "patterns")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, LISTS):
            part = batch.slice(at, LISTS)
            (rows, lens), (uses, _) = _numbers(part.column("rows")), _numbers(part.column("uses"))
            numbers = (lens, rows, uses, part.column("times").to_numpy())
            arrays = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in numbers]
            yield pa.RecordBatch.from_arrays(arrays, ["lens", "rows", "uses", "times"])


class _Block(NamedTuple):
    """Terms or patterns, their numbers of rows and how many terms they stand for; per entry its row and uses."""

    lens: np.ndarray
    rows: np.ndarray
    uses: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, row: Row) -> _Block:
        return cls(*(np.frombuffer(row[name], np.int32) for name in ("lens", "rows", "uses", "times")))

    def by_term(self, entries: np.ndarray) -> np.ndarray:
        return np.add.reduceat(entries, np.cumsum(self.lens) - self.lens)

    def by_row(self, entries: np.ndarray, of_term: np.ndarray, rows: int) -> np.ndarray:
        return np.bincount(self.rows, entries * np.repeat(of_term, self.lens), rows)


def _summed(blocks: RDD, work: Callable[[Iterator], np.ndarray]) -> np.ndarray | float:
    """The sum over all tasks of the array that each makes of its blocks."""
    return blocks.mapPartitions(lambda part: [work(part)]).treeAggregate(0.0, np.add, np.add)


class Setting(NamedTuple):
    """Terms of fewer than `least` or more than `most` training rows are left out."""

    penalty: float
    least: float = 1.0
    most: float = float("inf")


@dataclass
class Fit:
    """Coefficients of all rows (zero outside the training part), a row's length by terms, intercepts, all rows' margins."""

    setting: Setting
    inside: np.ndarray
    coefficients: np.ndarray
    inverse: np.ndarray
    intercepts: np.ndarray
    margins: np.ndarray


def _idf(block: _Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    df = block.by_term(inside[block.rows].astype(np.int64))
    return df, np.log((inside.sum() + 1) / (df + 1))


def _kept(df: np.ndarray, setting: Setting) -> np.ndarray:
    return (df > 0) & (df >= setting.least) & (df <= setting.most)


def _inverse_lengths(blocks: RDD, inside: np.ndarray, settings: list[Setting]) -> np.ndarray:
    """Rows x settings: one over the length of each row by TF-IDF, zero where no term is left."""
    shared = blocks.context.broadcast(inside)

    def work(part: Iterator[_Block]) -> np.ndarray:
        inside = shared.value
        # Below the rows, how many terms are left.
        out = np.zeros((len(settings), len(inside) + 1))
        for block in part:
            df, idf = _idf(block, inside)
            for to, setting in zip(out, settings, strict=True):
                times = np.where(_kept(df, setting), block.times, 0)
                to[:-1] += block.by_row(block.uses.astype(np.float64) ** 2, times * idf**2, len(inside))
                to[-1] += times.sum()
        return out

    sums = _summed(blocks, work) + np.zeros((len(settings), len(inside) + 1))
    shared.destroy()
    if not sums[:, -1].all():
        raise ValueError("The vocabulary size should be > 0. Lower the least number of rows as necessary.")
    lengths = np.sqrt(sums[:, :-1].T)
    return np.divide(1.0, lengths, out=np.zeros_like(lengths), where=lengths > 0)


def _scales(block: _Block, inside: np.ndarray, inverse: np.ndarray, setting: Setting) -> np.ndarray:
    """Per term, what the product of two rows' uses over their lengths counts: squared IDF over variance.

    The variance has the squared IDF as a factor too, so it drops out, but a term of every row is none.
    """
    n = inside.sum()
    df, idf = _idf(block, inside)
    values = block.uses * np.where(inside, inverse, 0.0)[block.rows]
    spread = block.by_term(values * values) - block.by_term(values) ** 2 / n
    used = _kept(df, setting) & (idf > 0) & (spread > 0)
    return np.divide(n - 1.0, spread, out=np.zeros(len(df)), where=used)


def _products(scaled: RDD, inverse: np.ndarray, asked: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Inner products of all rows, by each asked setting, times its vectors."""
    columns = [(i, asked[i][:, k] * inverse[:, i]) for i in asked for k in range(asked[i].shape[1])]
    shared = scaled.context.broadcast(columns)

    def work(part: Iterator[tuple[_Block, np.ndarray]]) -> np.ndarray:
        columns = shared.value
        out = np.zeros((len(columns), len(columns[0][1])))
        for block, scales in part:
            for to, (i, vector) in zip(out, columns, strict=True):
                to += block.by_row(block.uses, block.by_term(block.uses * vector[block.rows]) * scales[i], len(vector))
        return out

    sums = _summed(scaled, work) + np.zeros((len(columns), len(inverse)))
    shared.destroy()
    out, at = {}, 0
    for i, vectors in asked.items():
        out[i] = sums[at : at + vectors.shape[1]].T * inverse[:, i : i + 1]
        at += vectors.shape[1]
    return out


def _few(blocks: Iterator[_Block]) -> Iterator[_Block]:
    """Blocks joined up to some size."""
    held: list[_Block] = []
    for block in blocks:
        held.append(block)
        if sum(len(b.rows) for b in held) >= BLOCK:
            yield _Block(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held = []
    if held:
        yield _Block(*(np.concatenate(x) for x in zip(*held, strict=True)))


def fitted(table: DataFrame, labels: np.ndarray, classes: int, inside: np.ndarray, settings: list[Setting], iterations: int) -> Iterator[Fit]:
    """The regression of the patterns' rows `inside`, by each setting; searches go side by side and ask in one job."""
    columns = classes if classes > 2 else 1
    together = max(1, HELD // (4 * REMEMBERED * columns * max(int(inside.sum()), 1)))
    context = table.sparkSession.sparkContext
    blocks = table.coalesce(context.defaultParallelism).rdd.map(_Block.of).mapPartitions(_few)
    for at in range(0, len(settings), together):
        some = settings[at : at + together]
        inverse = _inverse_lengths(blocks, inside, some)
        shared = context.broadcast((inside, inverse, some))

        def with_scales(block: _Block, shared: Broadcast = shared) -> tuple[_Block, np.ndarray]:
            inside, inverse, some = shared.value
            return block, np.stack([block.times * _scales(block, inside, inverse[:, i], s) for i, s in enumerate(some)])

        # Read at every step.
        scaled = blocks.map(with_scales).persist(StorageLevel.MEMORY_AND_DISK)

        def product(asked: dict[int, np.ndarray], inverse: np.ndarray = inverse, scaled: RDD = scaled) -> dict[int, np.ndarray]:
            return _products(scaled, inverse, {i: _everywhere(v, inside) for i, v in asked.items()})

        searches = {i: search(labels[inside], classes, s.penalty, iterations) for i, s in enumerate(some)}
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        made: dict[int, np.ndarray | None] = dict.fromkeys(searches)
        while made:
            asked = {}
            for i, answer in made.items():
                try:
                    asked[i] = searches[i].send(None if answer is None else _centred(answer[inside]))
                except StopIteration as end:
                    found[i] = end.value
                    del searches[i]
            made = product(asked) if asked else {}
        last = product({i: coefficients for i, (coefficients, _) in found.items()})
        scaled.unpersist()
        shared.destroy()
        for i, setting in enumerate(some):
            coefficients, intercepts = found[i]
            intercepts = intercepts - last[i][inside].mean(axis=0)
            yield Fit(setting, inside, _everywhere(coefficients, inside), inverse[:, i], intercepts, last[i] + intercepts)


def _centred(vectors: np.ndarray) -> np.ndarray:
    return vectors - vectors.mean(axis=0)


def _everywhere(vectors: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Centred coefficients, as centred terms ask for, and zeros for the rows outside."""
    out = np.zeros((len(inside), vectors.shape[1]))
    out[inside] = _centred(vectors)
    return out


def weights(lists: DataFrame, fit: Fit) -> DataFrame:
    """(term, df, idf, weight): every term's weight per margin, to be multiplied by its uses over the row's length."""
    shared = lists.sparkSession.sparkContext.broadcast((fit.inside, fit.inverse, fit.coefficients, fit.setting))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, inverse, coefficients, setting = shared.value
        vectors = (coefficients * inverse[:, None]).T
        for whole in batches:
            for at in range(0, whole.num_rows, LISTS):
                batch = whole.slice(at, LISTS)
                (rows, lens), (uses, _) = _numbers(batch.column("rows")), _numbers(batch.column("uses"))
                block = _Block(lens, rows, uses, np.ones(len(lens), np.int32))
                df, idf = _idf(block, inside)
                scales = _scales(block, inside, inverse, setting)
                found = np.stack([block.by_term(uses * v[rows]) * scales for v in vectors], axis=1)
                ends = pa.array(np.arange(len(df) + 1) * len(vectors), pa.int32())
                arrays = [batch.column("term"), pa.array(df), pa.array(idf), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))]
                found = pa.RecordBatch.from_arrays(arrays, ["term", "df", "idf", "weight"])
                yield found.filter(pa.array(_kept(df, setting)))

    out = written(lists.mapInArrow(run, "term string, df bigint, idf double, weight array<double>"), "term-weights")
    shared.destroy()
    return out


def sums_of_weights(rows: DataFrame, table: DataFrame, columns: int) -> DataFrame:
    """(row, length, s0, s1, ...) of (row, words) with a known term: its length by TF-IDF, and uses times weights, summed."""
    names = [f"s{i}" for i in range(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (numbers, sizes), (uses, _) = _numbers(batch.column(0)), _numbers(batch.column(1))
            found, where = np.unique(numbers, return_inverse=True)
            idf = np.repeat(batch.column(2).to_numpy(), sizes)
            weight = np.repeat(batch.column(3).flatten().to_numpy().reshape(-1, columns), sizes, axis=0)
            values = [(uses * idf) ** 2, *(uses * weight[:, i] for i in range(columns))]
            arrays = [pa.array(np.bincount(where, v, len(found))) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *arrays], ["row", "square", *names])

    known = lookup_join(term_uses(rows), table, "term", weight="df").select("rows", "uses", "idf", "weight")
    parts = known.mapInArrow(run, ", ".join(["row int, square double", *(f"{name} double" for name in names)]))
    return parts.groupBy("row").agg(F.sqrt(F.sum("square")).alias("length"), *[F.sum(name).alias(name) for name in names])


def probabilities(margins: Column, columns: int) -> Column:
    """The classes' probabilities, an array."""
    if columns == 1:
        one = 1 / (1 + F.exp(-F.get(margins, F.lit(0))))
        return F.array(1 - one, one)
    raised = F.transform(margins, lambda m: F.exp(m - F.array_max(margins)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda s, y: s + y))


# The search, on the driver


class _Point(NamedTuple):
    """Coefficients of rows, the rows' margins by them, and intercepts."""

    rows: np.ndarray
    margins: np.ndarray
    intercepts: np.ndarray

    def dot(self, other: _Point) -> np.float64:
        return np.vdot(self.rows, other.margins) + self.intercepts @ other.intercepts

    def plus(self, times: float, other: _Point) -> _Point:
        return _Point(*(mine + times * its for mine, its in zip(self, other, strict=True)))

    def times(self, factor: float) -> _Point:
        return _Point(*(factor * mine for mine in self))


def loss(margins: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean logistic loss, and its slope by each margin."""
    n, columns = margins.shape
    if columns == 1:
        value = np.mean(np.logaddexp(0, margins[:, 0]) - labels * margins[:, 0])
        return value, (0.5 * (1 + np.tanh(margins / 2)) - labels[:, None]) / n
    shifted = margins - margins.max(axis=1, keepdims=True)
    raised = np.exp(shifted)
    sums = raised.sum(axis=1, keepdims=True)
    own = np.arange(n), labels
    slope = raised / sums
    slope[own] -= 1
    return np.mean(np.log(sums[:, 0]) - shifted[own]), slope / n


def search(labels: np.ndarray, classes: int, penalty: float, iterations: int) -> Search:
    """Coefficients and intercepts of least penalised loss; asks for products with vectors of coefficients.

    Starts from the labels' shares. Ends after `iterations` steps, or when the loss or its slope says so.
    """
    counts = np.bincount(labels, minlength=classes)
    x = np.zeros((len(labels), classes if classes > 2 else 1))
    if (counts > 0).sum() == 1:
        # One label alone: certain.
        return x, np.where(counts > 0, 0.0, -np.inf) if classes > 2 else np.array([np.inf if labels[0] else -np.inf])
    intercepts = _centred(np.log1p(counts)) if classes > 2 else np.log(counts[1:] / counts[0])
    here = _Point(x, x, intercepts)

    def along(t: float, way: _Point) -> tuple[float, float, np.ndarray]:
        """Value and slope `t` steps on, and the loss's slope by margins."""
        there = here.plus(t, way)
        value, slope = loss(there.margins + there.intercepts, labels)
        pull = penalty * np.vdot(there.rows, way.margins)
        return value + penalty / 2 * np.vdot(there.rows, there.margins), np.vdot(slope, way.margins + way.intercepts) + pull, slope

    def slope_at(point: _Point, slope: np.ndarray, product: np.ndarray) -> _Point:
        return _Point(slope + penalty * point.rows, product + penalty * point.margins, slope.sum(axis=0))

    value, _, by_margin = along(0.0, here)
    slope = slope_at(here, by_margin, (yield by_margin))
    first, values, steps, failed, taken = value, [np.inf], [], False, 0
    while taken < iterations:
        settled = len(values) > 1 and abs(value - max(values)) <= TOLERANCE * first
        if settled or np.sqrt(slope.dot(slope)) <= max(TOLERANCE * value, 1e-8):
            break
        try:
            way = _way(slope, steps)
            size = _step_size(lambda t, way=way: along(t, way)[:2], 1.0 if taken else 1.0 / np.sqrt(way.dot(way)))
        except ArithmeticError:
            # Once more without memory, then no further.
            if failed:
                break
            failed, steps = True, []
            continue
        value, _, by_margin = along(size, way)
        here = here.plus(size, way)
        new = slope_at(here, by_margin, (yield by_margin))
        steps = [(way.times(size), new.plus(-1.0, slope)), *steps][:REMEMBERED]
        slope, values, failed, taken = new, [*values, value][-LOSSES:], False, taken + 1
    return here.rows, here.intercepts


def _way(slope: _Point, steps: list[tuple[_Point, _Point]]) -> _Point:
    """Where to go: the slope, turned round and bent by the steps before, the last one first."""
    way, used = slope, []
    for step, change in steps:
        rho = step.dot(change)
        a = step.dot(way) / rho
        if np.isnan(a):
            raise ArithmeticError("no curvature")
        used.append((a, rho))
        way = way.plus(-a, change)
    if steps:
        scale = steps[0][0].dot(steps[0][1]) / steps[0][1].dot(steps[0][1])
        if not scale >= 0:
            raise ArithmeticError("no curvature")
        way = way.times(scale)
    for (step, change), (a, rho) in reversed(list(zip(steps, used, strict=True))):
        way = way.plus(a - change.dot(way) / rho, step)
    return way.times(-1.0)


def _step_size(along: Callable[[float], tuple[float, float]], size: float, enough: float = 1e-4, flat: float = 0.9, tries: int = 10) -> float:
    """A step by the strong Wolfe conditions (Nocedal and Wright, algorithms 3.5 and 3.6)."""
    start, fall = along(0.0)
    if fall > 0:
        raise ArithmeticError("not downhill")
    low = (0.0, start, fall)

    def between(low: tuple, high: tuple) -> float:
        for _ in range(tries):
            t = _cubic(*sorted((low, high)))
            value, slope = along(t)
            if value > start + enough * t * fall or value >= low[1]:
                high = (t, value, slope)
                continue
            if abs(slope) <= flat * abs(fall):
                return t
            if slope * (high[0] - low[0]) >= 0:
                high = low
            low = (t, value, slope)
        raise ArithmeticError("no step found")

    for i in range(tries):
        value, slope = along(size)
        if not np.isfinite(value):
            size /= 2
            continue
        if value > start + enough * size * fall or (i and value >= low[1]):
            return between(low, (size, value, slope))
        if abs(slope) <= flat * abs(fall):
            return size
        if slope >= 0:
            return between((size, value, slope), low)
        low = (size, value, slope)
        size *= 1.5
    raise ArithmeticError("no step found")


def _cubic(left: tuple, right: tuple) -> float:
    """The least of the cubic through both ends, kept away from them."""
    (a, at_a, slope_a), (b, at_b, slope_b) = left, right
    one = slope_a + slope_b - 3 * (at_a - at_b) / (a - b)
    two = np.sqrt(one * one - slope_a * slope_b)
    t = b - (b - a) * (slope_b + two - one) / (slope_b - slope_a + 2 * two)
    if t < a + 0.1 * (b - a):
        return a + 0.1 * (b - a)
    return a + 0.9 * (b - a) if t > a + 0.9 * (b - a) else t

"""L2 logistic regression, each step one aggregate over the data: by Newton steps for columns, by quasi-Newton steps for sparse codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortspark.functions.scalars import logistic

MAX_INPUTS = 1_000  # their products, half a million numbers, reach the driver
STEPS = 25
CLOSE = 1e-10  # a step that changes no weight by more ends the fit
HALVINGS = 30


@dataclass(frozen=True)
class LogisticFit:
    """Weights by input name; `rows` with a known label and known inputs were fitted."""

    weights: dict[str, float]
    intercept: float
    rows: int
    steps: int
    loss: float

    def probability(self) -> Column:
        """The probability of label 1, a column expression; NULL where an input is unknown (NULL or NaN)."""
        if not np.isfinite(self.intercept):  # only one class was seen
            return F.lit(1.0 if self.intercept > 0 else 0.0)
        x = sum((F.col(c).cast("double") * F.lit(w) for c, w in self.weights.items()), F.lit(self.intercept))
        x = F.nanvl(x, F.lit(None).cast("double"))
        # exp of a large number is infinite, and its share not a number: far from 0 the share is 1 or 0.
        return F.when(x > 700, F.lit(1.0)).otherwise(logistic(x))

    def holdout(self, test: DataFrame, label: str) -> DataFrame:
        """One row: labelled rows with known inputs, how many were predicted right, and as 1."""
        p = test.select(self.probability().alias("p"), F.col(label).cast("int").alias("y")).filter("p IS NOT NULL AND y IS NOT NULL")
        said = F.when(F.col("p") > 0.5, 1).otherwise(0)
        return p.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(said == F.col("y"), 1).otherwise(0)), F.lit(0)).alias("right"),
            F.coalesce(F.sum(said), F.lit(0)).alias("positive"),
        )


def sums_at(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and (row by row) Hessian of the log loss at the weights, and the number of rows and of ones.

    `rows` is (x: array of the inputs and a last 1, y). Each task adds up its batches, the tasks' sums meet by place.
    """
    d = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 + d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            y = batch.column(1).to_numpy()
            z = x @ weights
            p = np.exp(-np.logaddexp(0, -z))
            total[:3] += np.logaddexp(0, z).sum() - (y * z).sum(), len(y), y.sum()
            total[3 : 3 + d] += x.T @ (p - y)
            total[3 + d :] += (x.T @ (x * (p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["place", "value"])

    out = np.zeros(3 + d + d * d)
    for place, value in rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value")).collect():
        out[place] = value
    return out


def fit_newton(
    train: DataFrame, label: str, inputs: list[str], strength: float = 1.0, steps: int = STEPS, close: float = CLOSE
) -> LogisticFit:
    """Weights that minimise the log loss plus strength / 2 times their squares; the intercept is free.

    A Newton step takes one pass, which returns the sums of gradient and Hessian; a step that would raise the loss is halved.
    Rows with an unknown label or input (NULL or NaN) are left out. With one class only, weights are 0 and the intercept is
    infinite; without rows it is 0. `train` is read once a step: settle it first if it is costly to compute.
    """
    if len(inputs) > MAX_INPUTS:
        raise ValueError(f"{len(inputs)} inputs, at most {MAX_INPUTS}: their products reach the driver")
    numbers = [F.col(c).cast("double") for c in inputs]
    known = F.col(label).isNotNull()
    for x in numbers:
        known = known & x.isNotNull() & ~F.isnan(x)
    rows = train.filter(known).select(F.array(*numbers, F.lit(1.0)).alias("x"), F.col(label).cast("double").alias("y"))
    d = len(inputs) + 1
    ridge = np.append(np.full(d - 1, float(strength)), 0.0)
    weights = np.zeros(d)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int, int]:
        sums = sums_at(rows, w)
        hessian = sums[3 + d :].reshape(d, d) + np.diag(ridge)
        return sums[0] + (ridge * w * w).sum() / 2, sums[3 : 3 + d] + ridge * w, hessian, int(sums[1]), int(sums[2])

    loss, gradient, hessian, count, ones = at(weights)
    if ones in (0, count):
        return LogisticFit(dict.fromkeys(inputs, 0.0), float(np.inf if ones else -np.inf if count else 0.0), count, 0, 0.0)
    taken = 0
    for taken in range(1, steps + 1):
        move = np.linalg.solve(hessian, gradient)
        for _ in range(HALVINGS):
            found = at(weights - move)
            if found[0] <= loss + 1e-9 * abs(loss):
                break
            move = move / 2
        weights, (loss, gradient, hessian, _, _) = weights - move, found
        if np.abs(move).max() <= close:
            break
    return LogisticFit(dict(zip(inputs, weights[:-1].tolist())), float(weights[-1]), count, taken, float(loss))


MAX_CODES = 1_000_000  # weights of a sparse fit: the driver and every task hold them
MEMORY = 10  # pairs of moves and gradient changes that shape a step


@dataclass(frozen=True)
class SparseFit:
    """Weights by dense code id; `loss` is that of the fitted rows with the penalty."""

    weights: np.ndarray
    intercept: float
    rows: int
    passes: int
    loss: float

    def score(self, df: DataFrame, ids: str = "ids", counts: str = "counts") -> DataFrame:
        """Add `probability` of label 1; unknown or empty codes leave the intercept. Ids beyond the weights do not count."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)
        intercept, schema = self.intercept, StructType([*df.schema.fields, StructField("probability", DoubleType())])
        at = [df.columns.index(ids), df.columns.index(counts)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, codes, values = _entries(batch.column(at[0]), batch.column(at[1]), len(shared.value))
                z = np.bincount(rows, shared.value[codes] * values, batch.num_rows) + intercept
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.exp(-np.logaddexp(0, -z)))], schema.names)

        return df.mapInArrow(run, schema)


def _entries(ids: pa.Array, counts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, count) of every entry of a batch of sparse vectors."""
    rows = pc.list_parent_indices(ids).to_numpy()
    codes, values = pc.list_flatten(ids).to_numpy(), pc.list_flatten(counts).to_numpy()
    known = (codes >= 0) & (codes < size)
    return rows[known], codes[known], values[known]


def fit_sparse(
    train: DataFrame, label: str, size: int, ids: str = "ids", counts: str = "counts", strength: float = 1.0, passes: int = 200, close: float = 1e-6
) -> SparseFit:
    """The fit of `fit_newton` for sparse vectors of `size` dense codes (`dense_ids`, `code_vectors`).

    Limited-memory quasi-Newton steps: a pass returns the loss and the gradient, added up in the tasks and by code; no product of
    codes is formed. Ends when no entry of the gradient exceeds `close` times the number of rows. Rows without label are left out; NULL
    vectors have no codes. With one class only the weights are 0 and the intercept is infinite.
    """
    if size > MAX_CODES:
        raise ValueError(f"{size} codes, at most {MAX_CODES}: their weights are in every task")
    rows = train.filter(F.col(label).isNotNull()).select(F.col(ids).cast("array<bigint>").alias("i"), F.col(counts).cast("array<double>").alias("c"), F.col(label).cast("double").alias("y"))
    spark = train.sparkSession
    taken = 0

    def at(w: np.ndarray) -> tuple[float, np.ndarray, int, int]:
        """Loss and gradient (the intercept last) with the penalty, rows and ones."""
        nonlocal taken
        taken += 1
        shared = spark.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = shared.value
            total = np.zeros(size + 4)
            for batch in batches:
                row, code, value = _entries(batch.column(0), batch.column(1), size)
                y = batch.column(2).to_numpy()
                z = np.bincount(row, weights[code] * value, batch.num_rows) + weights[size]
                away = np.exp(-np.logaddexp(0, -z)) - y
                total[:size] += np.bincount(code, away[row] * value, size)
                total[size:] += away.sum(), np.logaddexp(0, z).sum() - (y * z).sum(), len(y), y.sum()
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["place", "value"])

        out = np.zeros(size + 4)
        for place, value in rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value")).collect():
            out[place] = value
        shared.unpersist()
        gradient = out[: size + 1]
        gradient[:size] += strength * w[:size]
        return out[size + 1] + strength * (w[:size] ** 2).sum() / 2, gradient, int(out[size + 2]), int(out[size + 3])

    w = np.zeros(size + 1)
    loss, gradient, count, ones = at(w)
    if ones in (0, count):
        return SparseFit(w[:size], float(np.inf if ones else -np.inf if count else 0.0), count, taken, 0.0)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    while np.abs(gradient).max() > close * count and taken < passes:
        move = gradient.copy()
        shares = []
        for s, g in reversed(pairs):
            shares.append((s @ move) / (s @ g))
            move -= shares[-1] * g
        move *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.abs(gradient).max())
        for (s, g), a in zip(pairs, reversed(shares)):
            move += (a - (g @ move) / (s @ g)) * s
        for _ in range(HALVINGS):
            new_loss, new_gradient, _, _ = at(w - move)
            if new_loss <= loss - 1e-4 * (gradient @ move) or taken >= passes:
                break
            move = move / 2
        if new_loss > loss:
            break
        if -(move @ (new_gradient - gradient)) > 0:
            pairs = [*pairs[1 - MEMORY :], (-move, new_gradient - gradient)]
        w, loss, gradient = w - move, new_loss, new_gradient
    return SparseFit(w[:size], float(w[size]), count, taken, float(loss))

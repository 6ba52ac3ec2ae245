"""Learners that MLlib lacks, fitted by sums over all rows: squared-hinge machines, sigmoid curves, a perceptron of rectified units.

A step sends the parameters to the tasks, each of which returns one vector: its rows' share of the
loss, the gradient and, where there are few parameters, the second derivatives. The sums, whose length
does not depend on the rows, are all that reaches the driver. Results do not depend on how rows are
dealt out, but for rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize

#: Vectors, one a task, that the driver adds up itself.
DIRECT_PARTS = 64
#: Newton steps and the relative size of a gradient at which they end.
STEPS, TOLERANCE = 60, 1e-10


def summed(rows: DataFrame, fn: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``fn(vec, more)`` over the rows of (vec array<double>, more array<double>); ``fn`` takes matrices and returns ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                vec, more = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for i in range(2))
                total += fn(vec, more)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["total"])

    parts = rows.select("vec", "more").mapInArrow(run, "total array<double>")
    n = rows.rdd.getNumPartitions()
    while n > DIRECT_PARTS:
        n = math.ceil(math.sqrt(n))
        parts = parts.repartition(n).mapInArrow(add, "total array<double>")
    return sum((np.array(r[0]) for r in parts.collect()), np.zeros(size))


def table(df: DataFrame, features: Sequence[str], *more: Column) -> DataFrame:
    """(vec, more) of the rows, written out: every step reads it."""
    return materialize(df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("vec"), F.array(*[m.cast("double") for m in more]).alias("more")), "steps")


# --- Newton steps over several small fits at once --------------------------------------------------------

def newton(rows: DataFrame, start: np.ndarray, share: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
           penalty: np.ndarray) -> np.ndarray:
    """Minimise m convex functions of d parameters at once: start (m, d), ``penalty`` (d) of the halved squares.

    ``share(parameters, vec, more)`` gives the rows' losses (m), gradients (m, d) and second derivatives
    (m, d, d). A step that does not lower a function is halved for that function alone.
    """
    m, d = start.shape

    def at(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        total = summed(rows, lambda vec, more: np.concatenate([part.ravel() for part in share(w, vec, more)]), m + m * d + m * d * d)
        loss, slope, bend = total[:m], total[m : m + m * d].reshape(m, d), total[m + m * d :].reshape(m, d, d)
        return loss + 0.5 * (penalty * w * w).sum(axis=1), slope + penalty * w, bend + np.diag(penalty)

    w = start
    loss, slope, bend = at(w)
    first = np.maximum(np.abs(slope).max(axis=1), 1e-300)
    move, size = np.zeros((m, d)), np.zeros(m)
    for _ in range(STEPS):
        open_fits = np.abs(slope).max(axis=1) > TOLERANCE * np.maximum(first, 1.0)
        if not open_fits.any():
            break
        for i in np.flatnonzero(open_fits & (size == 0)):
            move[i], size[i] = np.linalg.lstsq(bend[i], slope[i], rcond=None)[0], 1.0
        tried = w - np.where(open_fits, size, 0.0)[:, None] * move
        new_loss, new_slope, new_bend = at(tried)
        better = open_fits & (new_loss <= loss)
        w, loss = np.where(better[:, None], tried, w), np.where(better, new_loss, loss)
        slope, bend = np.where(better[:, None], new_slope, slope), np.where(better[:, None, None], new_bend, bend)
        # The next direction where the step helped, half of the step where it did not; too small a step ends the fit.
        size = np.where(better, 0.0, size / 2)
        slope = np.where((open_fits & ~better & (size < 1e-8))[:, None], 0.0, slope)
    return w


def squared_hinge(df: DataFrame, features: Sequence[str], y: str, c: float, part: Column | None = None, parts: int = 1) -> np.ndarray:
    """(parts, features + 1) weights and intercept of linear machines: half the squared weights, the intercept's included,
    plus ``c`` times the summed squared hinge losses. Machine i leaves out the rows of ``part`` i; with one part none are left out."""
    rows = table(df, features, F.when(F.col(y) == 1, 1.0).otherwise(-1.0), part if part is not None else F.lit(-1))

    def share(w: np.ndarray, vec: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, sign = np.column_stack([vec, np.ones(len(vec))]), more[:, 0]
        losses, slopes, bends = [], [], []
        for i in range(len(w)):
            gap = np.where(more[:, 1] == i, 0.0, np.maximum(0.0, 1.0 - sign * (x @ w[i])))
            active = x[gap > 0]
            losses.append(c * (gap * gap).sum())
            slopes.append(-2.0 * c * (gap * sign) @ x)
            bends.append(2.0 * c * active.T @ active)
        return np.array(losses), np.array(slopes), np.array(bends)

    d = len(features) + 1
    return newton(rows, np.zeros((parts, d)), share, np.ones(d))


def margins(features: Sequence[str], weights: np.ndarray) -> Column:
    """Array of the margins of several machines."""
    terms = [sum((F.col(c).cast("double") * float(v) for c, v in zip(features, w)), F.lit(float(w[-1]))) for w in weights]
    return F.array(*terms)


def sigmoids(df: DataFrame, margin: Column, y: str, which: Column, curves: int) -> np.ndarray:
    """(curves, 2) slope and offset of logistic curves of a margin, curve i on the rows where ``which`` is i.

    The wanted values are (n1 + 1) / (n1 + 2) and 1 / (n0 + 2) instead of 1 and 0, which bounds the slope.
    """
    rows = materialize(df.select(F.array(margin).alias("vec"), F.array((F.col(y) == 1).cast("double"), which.cast("double")).alias("more")), "steps")
    counts = summed(rows, lambda vec, more: np.array([((more[:, 1] == i) & (more[:, 0] == b)).sum() for i in range(curves) for b in (0, 1)], float), 2 * curves).reshape(curves, 2)
    low, high = 1.0 / (counts[:, 0] + 2.0), (counts[:, 1] + 1.0) / (counts[:, 1] + 2.0)

    def share(w: np.ndarray, vec: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        losses, slopes, bends = [], [], []
        for i in range(len(w)):
            own = more[:, 1] == i
            x = np.column_stack([vec[own, 0], np.ones(own.sum())])
            wanted, z = np.where(more[own, 0] == 1, high[i], low[i]), x @ w[i]
            p = 0.5 * (1.0 + np.tanh(z / 2))
            losses.append((np.logaddexp(0.0, z) - wanted * z).sum())
            slopes.append((p - wanted) @ x)
            bends.append((x * (p * (1 - p))[:, None]).T @ x)
        return np.array(losses), np.array(slopes), np.array(bends)

    start = np.column_stack([np.zeros(curves), np.log((counts[:, 1] + 1.0) / (counts[:, 0] + 1.0))])
    return newton(rows, start, share, np.zeros(2))


# --- perceptron ----------------------------------------------------------------------------------------

class Layers(NamedTuple):
    """Sizes of the layers, the output unit last, and how their parameters lie in one vector."""

    sizes: tuple[int, ...]

    def split(self, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in zip(self.sizes, self.sizes[1:]):
            out.append((w[at : at + a * b].reshape(a, b), w[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def start(self, seed: int) -> np.ndarray:
        rng, parts = np.random.default_rng(seed), []
        for i, (a, b) in enumerate(zip(self.sizes, self.sizes[1:])):
            bound = math.sqrt((2.0 if i == len(self.sizes) - 2 else 6.0) / (a + b))
            parts.append(rng.uniform(-bound, bound, a * b + b))
        return np.concatenate(parts)

    def weights_only(self) -> np.ndarray:
        """1 for a weight, 0 for an offset."""
        return np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in zip(self.sizes, self.sizes[1:])])

    def outputs(self, w: np.ndarray, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Values of the hidden layers, the input first, and the output before its sigmoid."""
        held, layers = [x], self.split(w)
        for weight, offset in layers[:-1]:
            held.append(np.maximum(held[-1] @ weight + offset, 0.0))
        return held, (held[-1] @ layers[-1][0] + layers[-1][1])[:, 0]

    def gradient(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Summed log loss and its gradient."""
        held, z = self.outputs(w, x)
        back = (0.5 * (1.0 + np.tanh(z / 2)) - y)[:, None]
        parts = []
        for (weight, _), value in zip(reversed(self.split(w)), reversed(held)):
            parts.append(np.concatenate([(value.T @ back).ravel(), back.sum(axis=0)]))
            back = (back @ weight.T) * (value > 0)
        return float((np.logaddexp(0.0, z) - y * z).sum()), np.concatenate(parts[::-1])


class Perceptron(NamedTuple):
    layers: Layers
    weights: np.ndarray
    passes: int

    def score(self, features: Sequence[str]) -> Column:
        layers, weights = self.layers, self.weights

        @F.pandas_udf("double")
        def probability(vec: pd.Series) -> pd.Series:
            if not len(vec):
                return pd.Series([], dtype=float)
            return pd.Series(0.5 * (1.0 + np.tanh(layers.outputs(weights, np.stack(vec.to_numpy()))[1] / 2)))

        return probability(F.array(*[F.col(c).cast("double") for c in features]))


def fit_perceptron(df: DataFrame, features: Sequence[str], y: str, hidden: Sequence[int], alpha: float = 0.001, passes: int = 200, rate: float = 0.01,
                   patience: int = 10, least_gain: float = 1e-4, seed: int = 42) -> Perceptron:
    """Rectified hidden layers and a logistic unit: log loss plus alpha / (2 n) of the squared weights, Adam over whole passes.

    A tenth of the rows, by a hash of their values, is held out. The weights of the best pass by accuracy on
    it are kept, and ``patience`` passes without a gain of ``least_gain`` end the fit.
    """
    layers = Layers((len(features), *hidden, 1))
    held_out = F.pmod(F.xxhash64(*features, y), F.lit(10)) == 0
    rows = table(df, features, (F.col(y) == 1).cast("double"), held_out.cast("double"))
    sizes = summed(rows, lambda vec, more: np.array([(more[:, 1] == 0).sum(), (more[:, 1] == 1).sum()], float), 2)
    n, penalised, w = max(1.0, sizes[0]), layers.weights_only(), layers.start(seed)
    watch_all = sizes[1] == 0  # too few rows to hold any out
    mean, spread, best, best_w, waited, done = np.zeros_like(w), np.zeros_like(w), -np.inf, w, 0, 0

    def share(w: np.ndarray):
        def one(vec: np.ndarray, more: np.ndarray) -> np.ndarray:
            train = more[:, 1] == 0
            watched = np.ones(len(vec), bool) if watch_all else ~train
            hits = ((layers.outputs(w, vec[watched])[1] > 0) == (more[watched, 0] == 1)).sum()
            return np.concatenate([[hits], layers.gradient(w, vec[train], more[train, 0])[1]])
        return one

    for step in range(1, passes + 2):
        total = summed(rows, share(w), 1 + len(w))
        accuracy = total[0] / max(1.0, sizes.sum() if watch_all else sizes[1])
        waited = 0 if accuracy > best + least_gain else waited + 1
        if accuracy > best:
            best, best_w = accuracy, w
        if waited >= patience or step > passes:
            break
        done = step
        slope = (total[1:] + alpha * penalised * w) / n
        mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope * slope
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Perceptron(layers, best_w, done)

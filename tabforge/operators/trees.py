"""Forests and boosted trees that grow in the tasks, over features cut into at most 256 bins.

Rows with equal bins, label and weight are one row with a count; a count's bootstrap draw is the sum of its
rows' draws, so nothing is lost. A table of up to ``MOST_BYTES`` of such rows goes to the tasks. Each task
grows trees of its own and scores the different test rows, so no forest reaches the driver or is sent on: what
leaves a task is a sum of votes a test row and the importances. The trees follow MLlib's rules: impurity by Gini
or variance, the first best cut of a node's drawn features, no cut without a gain, leaves of equal prediction
joined. Larger tables give None, and the caller fits with MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize

#: Bytes of a table of different rows that the tasks get whole.
MOST_BYTES = 48 << 20
#: Cells of the histograms of the nodes that are split together.
MOST_CELLS = 1 << 20
#: Least gain of a cut, as a share of the impurity: below it is rounding.
LEAST_GAIN = 1e-9
#: Sums of votes travel as integers, so that their order does not matter.
VOTE = float(1 << 40)


# --- bins --------------------------------------------------------------------------------------------

def fit_bins(df: DataFrame, features: Sequence[str], most: int) -> list[np.ndarray]:
    """Ascending cuts of each feature, fewer than ``most``: midway between its values, quantiles where it has more values."""

    def some_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [np.zeros(0) for _ in features]
        for pdf in batches:
            for j, f in enumerate(features):
                if len(seen[j]) <= most:
                    seen[j] = np.unique(np.concatenate([seen[j], pdf[f].to_numpy(float)]))[: most + 1]
        yield pd.DataFrame({"feature": np.repeat(np.arange(len(features)), [len(s) for s in seen]).astype("int32"), "value": np.concatenate(seen)})

    values: dict[int, list[float]] = {}
    plain = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    for r in plain.mapInPandas(some_values, "feature int, value double").distinct().groupBy("feature").agg(F.sort_array(F.collect_set("value")).alias("values")).collect():
        values[r["feature"]] = r["values"]
    many = [j for j in range(len(features)) if len(values.get(j, [])) > most]
    cuts = [np.array(values.get(j, []), float) for j in range(len(features))]
    cuts = [(c[1:] + c[:-1]) / 2 for c in cuts]
    if many:
        probs = [i / most for i in range(1, most)]
        found = plain.agg(*[F.percentile_approx(features[j], probs, 10_000) for j in many]).first()
        for j, c in zip(many, found):
            cuts[j] = np.unique(np.array(c, float))
    return cuts


def _bin_sql(name: str, cuts: Sequence[float], lo: int, hi: int) -> str:
    """SQL of the number of ``cuts`` below a column, by halves."""
    if lo == hi:
        return f"{lo}L"
    at = (lo + hi) // 2
    return f"if({name} <= {float(cuts[at])!r}D, {_bin_sql(name, cuts, lo, at)}, {_bin_sql(name, cuts, at + 1, hi)})"


def with_code(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray]) -> DataFrame:
    """``df`` with ``code``: the bin of each feature as a byte, eight features a word."""
    names = [f"_f{j}" for j in range(len(features))]
    wrong = F.raise_error(F.lit("a feature is null or not a number")).cast("double")
    numbers = [F.col(f"`{f}`").cast("double") for f in features]
    checked = df.withColumns({n: F.when(x.isNull() | F.isnan(x), wrong).otherwise(x) for n, x in zip(names, numbers)})
    words = []
    for at in range(0, len(features), 8):
        parts = [F.shiftleft(F.expr(_bin_sql(names[j], cuts[j], 0, len(cuts[j]))), 8 * (7 - j % 8)) for j in range(at, min(at + 8, len(features)))]
        word = parts[0]
        for part in parts[1:]:
            word = word.bitwiseOR(part)
        words.append(F.unhex(F.lpad(F.hex(word), 16, "0")))
    return checked.withColumn("code", F.concat(*words)).drop(*names)


class Rows(NamedTuple):
    """Different rows: bins by feature, label, weight, count."""

    bins: list[np.ndarray]
    y: np.ndarray
    weight: np.ndarray
    n: np.ndarray


def _bins_of(codes: pa.ChunkedArray, features: int) -> list[np.ndarray]:
    flat = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), 8 * math.ceil(features / 8))
    return [np.ascontiguousarray(flat[:, j]) for j in range(features)]


def _different(df: DataFrame, columns: Sequence[str], row_bytes: int) -> pa.Table | None:
    """The different rows with their number ``n``, in order; None if they are too many."""
    found = materialize(df.groupBy(*columns).agg(F.count("*").alias("n")), "different-rows")
    if found.count() * row_bytes > MOST_BYTES:
        return None
    return found.toArrow().sort_by([(c, "ascending") for c in columns])


# --- one tree ----------------------------------------------------------------------------------------

class Tree(NamedTuple):
    """Nodes in the order of their levels; a leaf's feature is -1, a right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    total: np.ndarray  # classes: weight of each; numbers: weight, sum, sum of squares
    gain: np.ndarray

    def leaves(self, bins: Sequence[np.ndarray]) -> np.ndarray:
        """The leaf of every row."""
        x, node = np.stack(bins, axis=1), np.zeros(len(bins[0]), np.int64)
        open_rows = np.flatnonzero(self.feature[node] >= 0)
        while len(open_rows):
            at = node[open_rows]
            node[open_rows] = self.left[at] + (x[open_rows, self.feature[at]] > self.cut[at])
            open_rows = open_rows[self.feature[node[open_rows]] >= 0]
        return node

    def importance(self, features: int, classify: bool) -> np.ndarray:
        inner = self.feature >= 0
        weight = self.total[:, :].sum(axis=1) if classify else self.total[:, 0]
        # Only nodes that are still reached: what was joined into a leaf no longer counts.
        reached = np.zeros(len(self.feature), bool)
        reached[0], at = True, np.array([0])
        while len(at := at[inner[at]]):
            at = np.concatenate([self.left[at], self.left[at] + 1])
            reached[at] = True
        used = inner & reached
        return np.bincount(self.feature[used], weights=(self.gain * weight)[used], minlength=features)


def _impurity(parts: Sequence[np.ndarray], classify: bool) -> np.ndarray:
    """Gini of the weights of classes, or the variance of (weight, sum, sum of squares)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if classify:
            total = sum(parts)
            return np.where(total > 0, 1.0 - sum((p / total) ** 2 for p in parts), 0.0)
        return np.where(parts[0] > 0, np.maximum((parts[2] - parts[1] * parts[1] / parts[0]) / parts[0], 0.0), 0.0)


def _best_cuts(bins: Sequence[np.ndarray], sizes: Sequence[int], rows: np.ndarray, lengths: np.ndarray, stats: Sequence[np.ndarray], raw: np.ndarray, totals: np.ndarray,
               per_node: int, leaf: int, rng: np.random.Generator, classify: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain) of every node, -1 without one. ``rows`` lie node by node, ``lengths`` of each."""
    k, features = len(lengths), len(bins)
    drawn = rng.random((k, features)) if per_node < features else None
    chosen = drawn.argsort(axis=1).argsort(axis=1) < per_node if drawn is not None else None
    best, best_cut, best_gain = np.full(k, -1), np.zeros(k, np.int64), np.zeros(k)
    node = np.repeat(np.arange(k), lengths)
    impurity = _impurity(list(totals.T), classify)
    weight = totals.sum(axis=1) if classify else totals[:, 0]
    for f in range(features):
        wide = sizes[f]
        if wide < 2:
            continue
        if chosen is None:
            own, at, among = np.arange(k), node, rows
        else:
            own = np.flatnonzero(chosen[:, f])
            if not len(own):
                continue
            keep = chosen[node, f]
            at, among = (np.cumsum(chosen[:, f]) - 1)[node[keep]], rows[keep]
        cell = at * wide + bins[f][among]
        counts = np.bincount(cell, weights=raw[among], minlength=len(own) * wide)
        full = np.flatnonzero(counts)
        of, count = full // wide, counts[full]
        last = np.append(of[1:] != of[:-1], True)
        first = np.flatnonzero(np.append(True, last[:-1]))  # a node's first cell
        starts = np.repeat(first, np.diff(np.append(first, len(full))))

        def before(v: np.ndarray) -> np.ndarray:
            run = np.cumsum(v)
            return run - (run - v)[starts]

        left = [before(np.bincount(cell, weights=s[among], minlength=len(own) * wide)[full]) for s in stats]
        right = [totals[own[of], i] - left[i] for i in range(len(stats))]
        lefts, alls = before(count), np.bincount(of, weights=count, minlength=len(own))[of]
        left_w = sum(left) if classify else left[0]
        share = left_w / weight[own[of]]
        gain = impurity[own[of]] - share * _impurity(left, classify) - (1 - share) * _impurity(right, classify)
        gain[last | (lefts < leaf) | (alls - lefts < leaf)] = -1.0
        top = np.maximum.reduceat(gain, first)
        place = np.full(len(full), len(full))
        here = gain == np.repeat(top, np.diff(np.append(first, len(full))))
        place[here] = np.flatnonzero(here)
        where = np.minimum.reduceat(place, first)
        nodes = own[of[first]]
        better = top > best_gain[nodes]
        if drawn is not None:  # equal gains: the feature drawn first
            held = best[nodes]
            better |= (top == best_gain[nodes]) & (held >= 0) & (drawn[nodes, f] < drawn[nodes, held])
        nodes, where, top = nodes[better], where[better], top[better]
        best[nodes], best_cut[nodes], best_gain[nodes] = f, full[where] % wide, top
    best[best_gain <= LEAST_GAIN * impurity] = -1
    return best, best_cut, best_gain


def grow(bins: Sequence[np.ndarray], sizes: Sequence[int], stats: Sequence[np.ndarray], raw: np.ndarray, per_node: int, depth: int, leaf: int, rng: np.random.Generator, classify: bool) -> Tree:
    """A tree over the rows with a positive count ``raw``. ``sizes``: bins of each feature."""
    rows = np.flatnonzero(raw > 0)
    stats = [np.asarray(s, float) for s in stats]
    totals = np.array([[s[rows].sum() for s in stats]])
    lengths, ids, made = np.array([len(rows)]), np.array([0]), 1
    feature, cut, left, gains, all_totals, levels = [np.array([-1])], [np.array([0])], [np.array([0])], [np.zeros(1)], [totals], [np.array([0])]
    most = max(1, MOST_CELLS // max(sizes, default=1))
    for _ in range(depth):
        if not len(ids):
            break
        ends = np.cumsum(lengths)
        parts = []
        for lo in range(0, len(ids), most):
            hi = min(lo + most, len(ids))
            span = rows[ends[lo] - lengths[lo] : ends[hi - 1]]
            parts.append(_best_cuts(bins, sizes, span, lengths[lo:hi], stats, raw, totals[lo:hi], per_node, leaf, rng, classify))
        best, best_cut, gain = (np.concatenate([p[i] for p in parts]) for i in range(3))
        split = best >= 0
        k = int(split.sum())
        if not k:
            break
        first = np.where(split, made + 2 * (np.cumsum(split) - 1), 0)
        flat = [np.concatenate(a) for a in (feature, cut, left, gains)]
        for a, v in zip(flat, (best, best_cut, first, gain)):
            a[ids[split]] = v[split]
        node = np.repeat(np.arange(len(ids)), lengths)
        kept = split[node]
        rows, node = rows[kept], node[kept]
        right = np.zeros(len(rows), np.int64)
        for f in np.unique(best[split]):
            own = best[node] == f
            right[own] = bins[f][rows[own]] > best_cut[node[own]]
        child = 2 * (np.cumsum(split) - 1)[node] + right
        order = np.argsort(child, kind="stable")
        rows, child = rows[order], child[order]
        totals = np.stack([np.bincount(child, weights=s[rows], minlength=2 * k) for s in stats], axis=1)
        feature, cut, left, gains = ([flat[0], np.full(2 * k, -1)], [flat[1], np.zeros(2 * k, np.int64)], [flat[2], np.zeros(2 * k, np.int64)], [flat[3], np.zeros(2 * k)])
        all_totals.append(totals)
        ids = made + np.arange(2 * k)
        levels.append(ids)
        made += 2 * k
        unlike = _impurity(list(totals.T), classify) > np.finfo(float).eps * (1.0 if classify else np.maximum(1.0, totals[:, 2] / np.maximum(totals[:, 0], 1e-300)))
        lengths = np.bincount(child, minlength=2 * k)
        rows = rows[unlike[child]]
        ids, lengths, totals = ids[unlike], lengths[unlike], totals[unlike]
    tree = Tree(*(np.concatenate(a) for a in (feature, cut, left)), np.concatenate(all_totals), np.concatenate(gains))
    said = tree.total.argmax(axis=1) if classify else tree.total[:, 1] / tree.total[:, 0] if len(rows) or tree.total[0, 0] else np.zeros(1)
    for level in reversed(levels):  # leaves that say the same become one
        inner = level[tree.feature[level] >= 0]
        a = tree.left[inner]
        tree.feature[inner[(tree.feature[a] < 0) & (tree.feature[a + 1] < 0) & (said[a] == said[a + 1])]] = -1
    return tree


# --- many trees --------------------------------------------------------------------------------------

class Settings(NamedTuple):
    trees: int
    depth: int
    leaf: int = 1
    columns: float | str = "all"  # a node's features: all, sqrt, or a share
    rate: float = 0.1  # boosting: the weight of every tree but the first, and the share of rows each is fitted on
    rows: float = 1.0
    seed: int = 42


def _per_node(columns: float | str, features: int) -> int:
    return features if columns == "all" else math.ceil(math.sqrt(features)) if columns == "sqrt" else min(features, math.ceil(float(columns) * features))


def forest_tree(rows: Rows, sizes: Sequence[int], number: int, s: Settings, classes: int) -> Tree:
    """Tree ``number`` of a forest: a Poisson bootstrap of the rows. ``classes`` 0: regression."""
    rng = np.random.default_rng([s.seed, number])
    raw = rng.poisson(rows.n).astype(float)
    w = raw * rows.weight
    stats = [np.where(rows.y == c, w, 0.0) for c in range(classes)] if classes else [w, w * rows.y, w * rows.y * rows.y]
    return grow(rows.bins, sizes, stats, raw, _per_node(s.columns, len(rows.bins)), s.depth, s.leaf, rng, classes > 0)


def boosted_trees(rows: Rows, sizes: Sequence[int], s: Settings, classify: bool) -> Iterator[tuple[Tree, float, np.ndarray]]:
    """(tree, its weight, its value by node) one after the other: gradients of the log loss over labels -1 and 1, or of the squared error."""
    y, at = 2.0 * rows.y - 1.0 if classify else rows.y, np.zeros(len(rows.y))
    for i in range(s.trees):
        rng = np.random.default_rng([s.seed, i])
        aim = y if not i else 4.0 * y / (1.0 + np.exp(np.minimum(2.0 * y * at, 700.0))) if classify else 2.0 * (y - at)
        raw = (rng.binomial(rows.n, s.rows) if s.rows < 1 else rows.n).astype(float)
        w = raw * rows.weight
        tree = grow(rows.bins, sizes, [w, w * aim, w * aim * aim], raw, _per_node(s.columns, len(rows.bins)), s.depth, s.leaf, rng, False)
        value = tree.total[:, 1] / np.where(tree.total[:, 0] > 0, tree.total[:, 0], 1.0)
        step = s.rate if i else 1.0
        at = at + step * value[tree.leaves(rows.bins)]
        yield tree, step, value


class Prepared(NamedTuple):
    rows: Rows
    sizes: list[int]
    cuts: list[np.ndarray]
    classes: int


def prepare_rows(train: DataFrame, features: Sequence[str], bins: int, classify: bool) -> Prepared | None:
    """The different training rows, of (features, y and, if there is one, weight); None if they are too many for a task."""
    if bins > 256:
        return None
    weight = F.col("weight").cast("double") if "weight" in train.columns else F.lit(1.0)
    plain = train.select(*features, F.col("y").cast("double").alias("y"), weight.alias("weight"))
    cuts = fit_bins(plain, features, bins)
    found = _different(with_code(plain, features, cuts).select("code", "y", "weight"), ["code", "y", "weight"], len(features) + 24)
    if found is None:
        return None
    if not found.num_rows or found.column("y").null_count:
        raise ValueError("there are no rows, or a label is null")
    y, w, n = (found.column(c).to_numpy() for c in ("y", "weight", "n"))
    if np.isnan(y).any() or classify and ((y < 0) | (y != np.floor(y))).any():
        raise ValueError("a label is not a number, or not the number of a class")
    return Prepared(Rows(_bins_of(found.column("code"), len(features)), y, w, n), [len(c) + 1 for c in cuts], cuts, max(2, int(y.max()) + 1) if classify else 0)


def _in_tasks(spark, jobs: int, fn, schema: str) -> DataFrame:
    """``fn`` (numbers of jobs -> record batches) in as many tasks as the session can use."""
    tasks = max(1, min(jobs, max(32, 2 * spark.sparkContext.defaultParallelism)))
    return spark.range(0, jobs, 1, tasks).mapInArrow(lambda batches: fn([i for b in batches for i in b.column(0).to_pylist()]), schema)


def forest_scores(train: DataFrame, test: DataFrame, features: Sequence[str], s: Settings, bins: int, classify: bool) -> DataFrame | None:
    """(id, y, score, pred) of the test rows by a forest; None if there are too many different rows."""
    known = prepare_rows(train, features, bins, classify)
    if known is None:
        return None
    coded = with_code(test, features, known.cuts)
    asked = _different(coded.select("code"), ["code"], len(features) + 8 * max(1, known.classes) + 8)
    if asked is None:
        return None
    spark, classes = train.sparkSession, known.classes
    codes = asked.column("code").combine_chunks()
    sent = spark.sparkContext.broadcast((known.rows, known.sizes, _bins_of(asked.column("code"), len(features)), codes))
    names = [f"s{i}" for i in range(max(1, classes))]

    def run(numbers: list[int]) -> Iterator[pa.RecordBatch]:
        rows, sizes, tests, codes = sent.value
        if not numbers or not len(codes):
            return
        votes = np.zeros((len(codes), max(1, classes)))
        for number in numbers:
            tree = forest_tree(rows, sizes, number, s, classes)
            at = tree.leaves(tests)
            if classes:
                part = tree.total[at]
                whole = part.sum(axis=1, keepdims=True)
                votes += np.divide(part, whole, out=np.zeros_like(part), where=whole > 0)
            else:
                votes[:, 0] += tree.total[at, 1] / np.where(tree.total[at, 0] > 0, tree.total[at, 0], 1.0)
        columns = [pa.array(np.rint(votes[:, i] * VOTE).astype(np.int64)) for i in range(len(names))] if classes else [pa.array(votes[:, 0])]
        whole = pa.table([codes, *columns], names=["code", *names])
        yield from whole.to_batches(max_chunksize=20_000)

    kind = "long" if classes else "double"
    parts = _in_tasks(spark, s.trees, run, f"code binary, {', '.join(f'{n} {kind}' for n in names)}")
    votes = parts.groupBy("code").agg(*[F.sum(n).alias(n) for n in names])
    scored = coded.select("id", "y", "code").join(votes, "code")
    if not classes:
        return scored.select("id", "y", F.lit(None).cast("double").alias("score"), (F.col("s0") / s.trees).alias("pred"))
    most = F.greatest(*names)
    said = F.coalesce(*[F.when(F.col(n) == most, F.lit(float(i))) for i, n in enumerate(names)])
    return scored.select("id", "y", (F.col("s1") / sum(F.col(n) for n in names)).alias("score"), said.alias("pred"))


def boosted_scores(train: DataFrame, test: DataFrame, features: Sequence[str], s: Settings, bins: int, classify: bool) -> DataFrame | None:
    """(id, y, score, pred) of the test rows by boosted trees; None if there are too many different rows."""
    known = prepare_rows(train, features, bins, classify)
    if known is None:
        return None
    coded = with_code(test, features, known.cuts)
    asked = _different(coded.select("code"), ["code"], len(features) + 16)
    if asked is None:
        return None
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast((known.rows, known.sizes, _bins_of(asked.column("code"), len(features)), asked.column("code").combine_chunks()))

    def run(numbers: list[int]) -> Iterator[pa.RecordBatch]:
        if not numbers:
            return
        rows, sizes, tests, codes = sent.value
        at = np.zeros(len(codes))
        for tree, step, value in boosted_trees(rows, sizes, s, classify):
            at += step * value[tree.leaves(tests)]
        yield from pa.table([codes, pa.array(at)], names=["code", "at"]).to_batches(max_chunksize=20_000)

    # A fit is one task's work: written out, it isn't done again where the result is read twice.
    values = materialize(_in_tasks(spark, 1, run, "code binary, at double"), "boosted")
    scored = coded.select("id", "y", "code").join(values, "code")
    if not classify:
        return scored.select("id", "y", F.lit(None).cast("double").alias("score"), F.col("at").alias("pred"))
    return scored.select("id", "y", (1 / (1 + F.exp(-2 * F.col("at")))).alias("score"), (F.col("at") > 0).cast("double").alias("pred"))


def importances(train: DataFrame, features: Sequence[str], s: Settings, bins: int, classify: bool, boosted: bool) -> np.ndarray | None:
    """Share of each feature in the gains of a forest or of boosted trees; None if there are too many different rows."""
    known = prepare_rows(train, features, bins, classify)
    if known is None:
        return None
    spark, width = train.sparkSession, len(features)
    sent = spark.sparkContext.broadcast((known.rows, known.sizes))
    classes = known.classes

    def run(numbers: list[int]) -> Iterator[pa.RecordBatch]:
        rows, sizes = sent.value
        for number in numbers:
            if boosted:
                own = sum((tree.importance(width, False) for tree, _, _ in boosted_trees(rows, sizes, s, classify)), np.zeros(width))
            else:
                own = forest_tree(rows, sizes, number, s, classes).importance(width, classify)
                own = own / own.sum() if own.sum() > 0 else own
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([own], pa.list_(pa.float64()))], names=["tree", "own"])

    found = _in_tasks(spark, 1 if boosted else s.trees, run, "tree long, own array<double>").collect()  # one row a tree
    total = sum((np.array(r["own"]) for r in sorted(found, key=lambda r: r["tree"])), np.zeros(width))
    return total / total.sum() if total.sum() > 0 else total

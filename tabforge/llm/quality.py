"""Quality classifier: a sparse ensemble of rules over text statistics.

The paths of a small forest become conjunctions of bounds on statistics, a lasso logistic regression
keeps a few of them with weights, and these compile into one Spark column expression. Statistics are
built-in functions over whole texts; only the fit reads a sample, of at most ``most_rows`` labelled rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize

STATISTICS = ["log_words", "word_length", "distinct_words", "repeated_words", "upper", "digits", "symbols", "stops", "exclaimed", "lines", "distinct_lines"]


def statistics(docs: DataFrame, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns and the statistics of every row's whole text; a null text counts as empty, and shares of nothing are 0."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(*(keep or []), text.alias("_t"), F.split(text, r"\s+").alias("_w"), F.split(text, "\n").alias("_l"))

    def without(pattern: str) -> Column:
        return F.length("_t") - F.length(F.regexp_replace("_t", pattern, ""))

    n = F.greatest(F.length("_t"), F.lit(1)).cast("double")
    n_words = F.greatest(F.size("_w"), F.lit(1)).cast("double")
    repeated = F.size(F.filter(F.zip_with("_w", F.slice(F.col("_w"), 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: a == b), lambda same: same))
    return base.select(
        *[c for c in base.columns if not c.startswith("_")],
        F.log1p(F.when(F.length("_t") > 0, F.size("_w")).otherwise(0).cast("double")).alias("log_words"),
        (F.length("_t") / n_words).alias("word_length"),
        (F.size(F.array_distinct("_w")) / n_words).alias("distinct_words"),
        (repeated / n_words).alias("repeated_words"),
        (without(r"\p{Lu}+") / n).alias("upper"),
        (without(r"\p{Nd}+") / n).alias("digits"),
        (without(r"""[^\p{L}\p{N}\s.,;:!?'"()\-]+""") / n).alias("symbols"),
        (without(r"[.,;:?]+") / n).alias("stops"),
        ((F.length("_t") - F.length(F.replace("_t", F.lit("!"), F.lit("")))) / n).alias("exclaimed"),
        (F.size("_l") / n_words).alias("lines"),
        (F.size(F.array_distinct("_l")) / F.greatest(F.size("_l"), F.lit(1))).alias("distinct_lines"),
    )


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction of bounds: low < statistic <= high for each (statistic, low, high)."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        tests = [F.col(s) > F.lit(a) for s, a, _ in self.bounds if a > -math.inf] + [F.col(s) <= F.lit(b) for s, _, b in self.bounds if b < math.inf]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


@dataclass
class RuleEnsemble:
    """Intercept and weighted rules; ``score`` is the probability of label 1 as a column of statistics."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        terms = [F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in sorted(self.weights.items())]
        while len(terms) > 1:  # a balanced sum keeps the expression shallow
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        z = F.lit(self.intercept) + (terms[0] if terms else F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_SPLIT = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)")


def rules_of(debug: str, names: list[str]) -> set[Rule]:
    """Every path from a root to another node of the printed trees, with the bounds of one statistic joined."""
    found: set[Rule] = set()
    path: list[tuple[int, str, float, float]] = []
    for line in debug.splitlines():
        m = _SPLIT.match(line)
        if not m:
            continue
        depth, name, value = len(m[1]), names[int(m[3])], float(m[5])
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, name, -math.inf, value) if m[4] == "<=" else (depth, name, value, math.inf))
        bounds: dict[str, tuple[float, float]] = {}
        for _, s, a, b in path:
            low, high = bounds.get(s, (-math.inf, math.inf))
            bounds[s] = max(low, a), min(high, b)
        found.add(Rule(tuple((s, a, b) for s, (a, b) in sorted(bounds.items()))))
    return found


def fired(points: DataFrame, rules: list[Rule], slice_rows: int = 1_000) -> DataFrame:
    """(y, r): for every row of statistics, a 1 for each rule that holds and a 0 for each other.

    Evaluated in the tasks. As column expressions, the hundreds of rules would be planned, compiled and
    sent again in each of the fit's passes, and the driver holds what that takes.
    """
    tests = [[(STATISTICS.index(s), low, high) for s, low, high in rule.bounds] for rule in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(start, slice_rows)
                x = [np.asarray(batch.column(1 + k), np.float64) for k in range(len(STATISTICS))]
                flags = np.ones((len(rules), batch.num_rows), bool)
                for holds, bounds in zip(flags, tests):
                    for k, low, high in bounds:
                        holds &= (x[k] > low) & (x[k] <= high)
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(rules)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flags.T.astype(np.int8).ravel())], names=["y", "r"])

    return points.select("y", *STATISTICS).mapInArrow(run, "y double, r array<tinyint>")


def fit(rows: DataFrame, label: str = "label", trees: int = 24, depth: int = 4, penalty: float = 5e-4, seed: int = 17) -> RuleEnsemble:
    """Fit on ``rows``, which hold the statistics and a 0/1 label. No rows score 0.5; one class alone scores its own smoothed share."""
    n, ones = rows.agg(F.count("*"), F.sum(label)).first()
    if not n or ones in (0, n):
        p = ((ones or 0) + 0.5) / (n + 1.0)
        return RuleEnsemble(math.log(p / (1 - p)))
    points = VectorAssembler(inputCols=STATISTICS, outputCol="x").transform(rows).select("x", F.col(label).cast("double").alias("y"), *STATISTICS)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=max(1, min(10, n // 50)),
                                    featureSubsetStrategy="onethird", seed=seed, cacheNodeIds=False).fit(points)
    rules = sorted(set().union(*[rules_of(t.toDebugString, STATISTICS) for t in forest.trees]))
    if not rules:
        p = ones / n
        return RuleEnsemble(math.log(p / (1 - p)))
    flags = materialize(fired(points, rules), "quality-rules").select("y", array_to_vector(F.col("r").cast("array<double>")).alias("r"))
    lasso = LogisticRegression(featuresCol="r", labelCol="y", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=80).fit(flags)
    return RuleEnsemble(lasso.intercept, {r: w for r, w in zip(rules, lasso.coefficients.toArray().tolist()) if w})


def votes_of(labels: DataFrame, id_col: str, label_col: str, held_out: Column, most_rows: int) -> DataFrame:
    """(_id, label) of at most about ``most_rows`` ids that aren't held out: the majority of an id's labels (ties: 1).

    Null ids and labels don't count. Above the bound a share of the ids, chosen by hash, is kept.
    """
    valid = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    votes = valid.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("label")).filter(~F.coalesce(held_out, F.lit(False)))
    n = votes.count()
    return votes.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * most_rows / n)) if n > most_rows else votes


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          held_out: Column | None = None, most_rows: int = 40_000) -> RuleEnsemble:
    """Fit on the labelled rows of ``docs`` for which ``held_out`` (a column of the id, there named ``_id``) isn't true.

    Ids only find the labels; they, and every other column than the text, are no input of a score.
    """
    votes = votes_of(labels, id_col, label_col, F.lit(False) if held_out is None else held_out, most_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(votes), "_id")  # bounded by most_rows
    return fit(materialize(statistics(rows, "_text", [F.col("label")]), "quality-train"))


def score_documents(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``keep`` columns (default: all) of every row with score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts are scored like any other; equal texts get equal scores; no row is dropped.
    """
    own = docs.columns if keep is None else keep
    stats = statistics(docs, text_col, [F.struct(*own).alias("row")])
    scored = stats.select("row", model.score().alias("score"))
    return scored.select(*[F.col("row").getField(c).alias(c) for c in own], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, columns as they are, that the classifier doesn't reject.

    Null and empty texts are scored like any other, copies of a row stay or go together, and an empty
    table gives none. Columns travel in a struct, so none of their names can clash.
    """
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("_text"))
    return score_documents(packed, model, "_text", ["row"], threshold).filter("predicted = 1").select(*[F.col("row").getField(c).alias(c) for c in own])

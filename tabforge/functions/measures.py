"""Measures of an association rule, from antecedent (A), consequent (C) and joint (S) support."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_measures(a: Column, c: Column, s: Column) -> dict[str, Column]:
    confidence = s / a
    leverage = s - a * c
    zhang_base = F.greatest(s * (1 - a), a * (c - s))
    return {
        "antecedent_support": a,
        "consequent_support": c,
        "support": s,
        "confidence": confidence,
        "lift": confidence / c,
        "representativity": F.lit(1.0),  # no missing cells in a 0/1 table
        "leverage": leverage,
        "conviction": F.when(confidence < 1, (1 - c) / (1 - confidence)).otherwise(F.lit(float("inf"))),
        "zhangs_metric": F.when(zhang_base == 0, 0.0).otherwise(F.try_divide(leverage, zhang_base)),
        "jaccard": s / (a + c - s),
        "certainty": F.when(c < 1, F.try_divide(confidence - c, 1 - c)).otherwise(0.0),
        "kulczynski": (confidence + s / c) / 2,
    }


MEASURES = [
    "antecedent_support", "consequent_support", "support", "confidence", "lift", "representativity", "leverage",
    "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
]

"""Reusable column expressions: severities, bands, safe arithmetic, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SEVERITY_ORDER, SEVERITY_SCORE


def severity(value: Column, thresholds: Sequence[float], absolute: bool = True) -> Column:
    """Normal / Watch / Warning / Critical by >= (watch, warning, critical); NULL -> Normal."""
    watch, warning, critical = thresholds
    v = F.abs(value) if absolute else value
    return (
        F.when(value.isNull(), "Normal")
        .when(v >= critical, "Critical")
        .when(v >= warning, "Warning")
        .when(v >= watch, "Watch")
        .otherwise("Normal")
    )


def severity_rank(sev: Column) -> Column:
    expr = F.lit(0)
    for name, rank in SEVERITY_ORDER.items():
        expr = F.when(sev == name, rank).otherwise(expr) if rank else expr
    return expr


def rank_to_severity(rank: Column) -> Column:
    names = {v: k for k, v in SEVERITY_ORDER.items()}
    return (
        F.when(rank >= 3, names[3]).when(rank == 2, names[2]).when(rank == 1, names[1]).otherwise(names[0])
    )


def severity_score(sev: Column) -> Column:
    expr = F.lit(100.0)
    for name, score in SEVERITY_SCORE.items():
        expr = F.when(sev == name, score).otherwise(expr)
    return expr


def max_severity(*sevs: Column) -> Column:
    return rank_to_severity(F.greatest(*[severity_rank(s) for s in sevs]))


def weighted_health(sevs: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Weighted mean of severity scores, 2 decimals."""
    total = sum(weights.get(k, 1.0) for k in sevs)
    s = sum(severity_score(c) * F.lit(weights.get(k, 1.0)) for k, c in sevs.items())
    return F.round(s / F.lit(total), 2)


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    d = F.lit(default) if default is not None else F.lit(None).cast("double")
    return F.when((den.isNull()) | (den == 0), d).otherwise(num / den)


def r6(c: Column) -> Column:
    """Round final doubles to 6 places (engine-independent comparison)."""
    return F.round(c.cast("double"), 6)


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """pandas-style ``cut`` with right-closed bins (edges[i], edges[i+1]]; outside -> NULL."""
    expr = F.lit(None).cast("string")
    for i in range(len(labels) - 1, -1, -1):
        lo, hi = edges[i], edges[i + 1]
        cond = (value > lo) & (value <= hi) if right else (value >= lo) & (value < hi)
        expr = F.when(cond, labels[i]).otherwise(expr)
    return expr


def sig(c: Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (large-magnitude statistics such as variances)."""
    x = c.cast("double")
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    p = F.pow(F.lit(10.0), k)
    return F.when(x.isNull() | (x == 0), x).otherwise(F.round(x * p, 0) / p)

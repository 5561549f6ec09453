"""Small text helpers for writing the DuckDB twin queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ..config import SEVERITY_ORDER, SEVERITY_SCORE


def sev(expr: str, thresholds: Sequence[float]) -> str:
    watch, warning, critical = thresholds
    return (
        f"(CASE WHEN ({expr}) IS NULL THEN 'Normal' WHEN abs({expr}) >= {critical!r} THEN 'Critical' "
        f"WHEN abs({expr}) >= {warning!r} THEN 'Warning' WHEN abs({expr}) >= {watch!r} THEN 'Watch' ELSE 'Normal' END)"
    )


def sev_rank(expr: str) -> str:
    return "(CASE " + " ".join(f"WHEN {expr} = '{k}' THEN {v}" for k, v in SEVERITY_ORDER.items()) + " ELSE 0 END)"


def rank_sev(expr: str) -> str:
    return f"(CASE WHEN {expr} >= 3 THEN 'Critical' WHEN {expr} = 2 THEN 'Warning' WHEN {expr} = 1 THEN 'Watch' ELSE 'Normal' END)"


def sev_score(expr: str) -> str:
    return "(CASE " + " ".join(f"WHEN {expr} = '{k}' THEN {v!r}" for k, v in SEVERITY_SCORE.items()) + " ELSE 100.0 END)"


def max_sev(*exprs: str) -> str:
    return rank_sev("greatest(" + ", ".join(sev_rank(e) for e in exprs) + ")")


def health(sevs: Mapping[str, str], weights: Mapping[str, float]) -> str:
    total = sum(weights.get(k, 1.0) for k in sevs)
    s = "(0 + " + " + ".join(f"{sev_score(e)} * {weights.get(k, 1.0)!r}" for k, e in sevs.items()) + ")"
    return f"round({s} / {total!r}, 2)"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def sig(expr: str, digits: int = 10) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    p = f"power(10.0, {digits - 1} - floor(log10(abs({x}))))"
    return f"(CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} ELSE round({x} * {p}, 0) / {p} END)"

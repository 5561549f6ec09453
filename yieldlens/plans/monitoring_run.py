"""Drift run: reference/current record table -> feature and output drift, data quality, alerts, health.

One ``MonitoringRun`` builds each intermediate once (the feature-drift base is a
materialised, ranked distinct-value table) and every output is derived from it.
The drift and quality tables (a row a feature or metric) are stored, as alerts, health and summaries all read them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DriftConfig
from ..operators import drift as D
from ..operators import health as H
from ..session import cut_lineage


class MonitoringRun:
    def __init__(self, records: DataFrame, features: Sequence[str], run_id: str,
                 output_metrics: Sequence[str] = ("probability", "confidence", "uncertainty", "data_confidence"),
                 decision_col: str = "decision", cfg: DriftConfig | None = None):
        self.records, self.features, self.run_id = records, list(features), run_id
        self.output_metrics, self.decision_col = list(output_metrics), decision_col
        self.cfg = cfg or DriftConfig()

    @cached_property
    def feature_drift(self) -> DataFrame:
        return cut_lineage(D.feature_drift(self.records, self.features, self.cfg))

    @cached_property
    def feature_summary(self) -> DataFrame:
        return D.feature_drift_summary(self.feature_drift)

    @cached_property
    def output_drift(self) -> DataFrame:
        return cut_lineage(H.output_drift(self.records, self.output_metrics, self.cfg))

    @cached_property
    def category_drift(self) -> DataFrame:
        return cut_lineage(H.category_drift(self.records, self.decision_col, self.cfg))

    @cached_property
    def data_quality(self) -> DataFrame:
        return cut_lineage(H.data_quality(self.records, self.features))

    @cached_property
    def data_quality_summary(self) -> DataFrame:
        return H.data_quality_summary(self.data_quality)

    @cached_property
    def alerts(self) -> DataFrame:
        return H.alerts(self.run_id, self.feature_drift, self.output_drift, self.category_drift, self.data_quality)

    @cached_property
    def components(self) -> DataFrame:
        return H.health_components(self.feature_summary, self.output_drift, self.category_drift,
                                   self.data_quality_summary, self.cfg)

    @cached_property
    def assessment(self) -> DataFrame:
        rows = self.records.where(F.col("side") == D.CUR).agg(F.count(F.lit(1)).alias("current_rows"))
        return H.health_assessment(self.run_id, self.components, self.alerts, self.feature_summary,
                                   self.data_quality_summary, rows, self.cfg)

"""Staged batch: records + scores -> uncertainty and abstention -> attributions -> evidence -> report tables.

Each stage is built once per ``DecisionReport`` and reused by every output.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import evidence as EV
from ..operators import explain as X
from ..operators import priority as PR
from ..operators import uncertainty as U


class DecisionReport:
    def __init__(self, wide: DataFrame, scores: DataFrame, members: DataFrame, features: Sequence[str],
                 lower: float, upper: float):
        self.wide, self.scores, self.members = wide, scores, members
        self.features, self.lower, self.upper = list(features), lower, upper

    @cached_property
    def uncertainty(self) -> DataFrame:
        return U.confidence_components(self.wide, self.scores, self.members, self.features, self.lower, self.upper)

    @cached_property
    def attributions(self) -> DataFrame:
        return X.attributions(self.wide, self.features)

    @cached_property
    def by_record(self) -> DataFrame:
        """The attributions dealt by record, for what is grouped or ranked by record."""
        tasks = PR.tasks_for(self.wide.sparkSession, self.wide.count() * len(self.features))
        return X.attributions(self.wide, self.features, tasks=tasks)

    @cached_property
    def evidence(self) -> DataFrame:
        return EV.evidence_report(self.uncertainty, X.local_summary(self.by_record), self.scores, self.lower,
                                  self.upper)

    @cached_property
    def priorities(self) -> DataFrame:
        att = self.attributions
        return PR.sensor_priority(self.by_record, self.wide, self.features, X.global_importance(att), X.failure_features(att, None),
                                  dealt=True)

    @cached_property
    def index(self) -> DataFrame:
        return EV.report_index(self.evidence, PR.record_priority_summary(self.priorities))

    @cached_property
    def documents(self) -> DataFrame:
        return EV.report_document(self.evidence, X.local_top_k(self.by_record), self.priorities)

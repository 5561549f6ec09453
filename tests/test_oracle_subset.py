"""A slice of the DuckDB twins at sf0.001 (the full set runs via tests/oracle_harness.py at sf0.01)."""

import pytest

from oracle_harness import compare, duck
from paths import SF_SMALL

NAMES = ["feature_drift", "feature_manifest", "roc_auc", "policy_grid", "select_policy", "alerts",
         "error_diagnostics", "nearest_cases", "evidence_report", "session_analytics", "stream_window_profile",
         "stratified_folds", "build_master", "zone_features"]


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, name):
    import __spark_entry__ as e

    r = compare(spark, duck(SF_SMALL), name, e.queries()[name], e.oracle_sql()[name], SF_SMALL)
    assert r["status"] == "OK", r

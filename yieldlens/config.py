"""Configuration: thresholds, weights and labels.

Everything below the "fixed values" marker must equal the behaviour being
reproduced; it is stated plainly, in natural order, and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------

SEVERITY_ORDER = {"Normal": 0, "Watch": 1, "Warning": 2, "Critical": 3}
SEVERITY_SCORE = {"Normal": 100.0, "Watch": 82.0, "Warning": 58.0, "Critical": 25.0}

EPSILON = 1e-8
NUMBER_OF_BINS = 10
MINIMUM_REFERENCE_ROWS = 100
MINIMUM_CURRENT_ROWS = 30

FEATURE_DRIFT_THRESHOLDS = {
    "psi": (0.1, 0.2, 0.35),
    "ks_statistic": (0.1, 0.2, 0.3),
    "standardised_mean_shift": (0.25, 0.5, 1.0),
    "missing_rate_difference": (0.03, 0.08, 0.15),
}
FEATURE_METRIC_WEIGHTS = {
    "psi": 0.30,
    "ks_statistic": 0.25,
    "standardised_mean_shift": 0.20,
    "missing_rate_difference": 0.15,
    "constant_sensor_change": 0.07,
    "measurement_availability": 0.03,
}
PREDICTION_DRIFT_THRESHOLDS = {
    "probability_mean_shift": (0.02, 0.05, 0.1),
    "confidence_mean_shift": (0.05, 0.1, 0.2),
    "uncertainty_mean_shift": (0.05, 0.1, 0.2),
    "decision_total_variation": (0.08, 0.15, 0.25),
}
DATA_QUALITY_THRESHOLDS = {
    "missing_rate": (0.05, 0.15, 0.3),
    "duplicate_rate": (0.01, 0.03, 0.1),
    "constant_feature_rate": (0.02, 0.05, 0.1),
    "unmatched_feature_rate": (0.02, 0.05, 0.1),
}
HEALTH_WEIGHTS = {
    "data_quality": 0.25,
    "feature_drift": 0.35,
    "prediction_drift": 0.25,
    "confidence_and_uncertainty": 0.15,
}
# health band lower bounds and the severity each band maps to
HEALTH_BANDS = [(97.0, "Excellent"), (90.0, "Healthy"), (80.0, "Watch"), (65.0, "Warning"), (None, "Critical")]
BAND_SEVERITY = {"Excellent": "Normal", "Healthy": "Normal", "Watch": "Watch", "Warning": "Warning", "Critical": "Critical"}

ROLE_ALIASES = {
    "id": ["wafer_id", "record_id", "sample_id", "id"],
    "timestamp": ["timestamp", "datetime", "event_time", "recorded_at"],
    "target": ["target", "label", "failure", "actual_failure", "y_true"],
    "probability": [
        "calibrated_failure_probability",
        "failure_probability",
        "predicted_probability",
        "probability",
        "y_score",
    ],
    "decision": ["uncertainty_adjusted_decision", "operational_decision", "decision"],
    "confidence": ["prediction_confidence", "confidence", "model_confidence"],
    "uncertainty": ["combined_uncertainty", "uncertainty", "prediction_uncertainty"],
    "data_confidence": ["data_confidence", "input_data_confidence"],
    "familiarity": ["data_familiarity_band", "data_familiarity", "familiarity_band"],
}
FEATURE_PREFIXES = ["sensor_"]

# audit: session timeout, failed-login lock-out, retention
SESSION_TIMEOUT_MINUTES = 30
MAXIMUM_FAILED_ATTEMPTS = 5
LOCKOUT_MINUTES = 15
AUDIT_RETENTION_DAYS = 365

# three-way decision policy defaults and costs
DEFAULT_LOWER_THRESHOLD = 0.035
DEFAULT_UPPER_THRESHOLD = 0.08
DECISIONS = ["Low Risk", "Engineering Review", "High Risk"]
ADJUSTED_DECISIONS = ["Low Risk", "Engineering Review", "High Risk", "Insufficient Evidence"]
# policy cost = 20 * low-risk failures + 0.5 * review failures + 1 * review passes + 3 * high-risk passes
POLICY_COSTS = {"low_risk_failure": 20.0, "review_failure": 0.5, "review_pass": 1.0, "high_risk_pass": 3.0}
# operational cost = 10 * missed failures + 1 * false alarms
MISSED_FAILURE_COST = 10.0
FALSE_ALARM_COST = 1.0
MINIMUM_RECALL = 0.75


@dataclass(frozen=True)
class Roles:
    """Column roles of a record table (what each column means)."""

    id: str = "record_id"
    ts: str = "ts"
    target: str = "target"
    side: str = "side"
    probability: str = "probability"


@dataclass(frozen=True)
class DriftConfig:
    epsilon: float = EPSILON
    number_of_bins: int = NUMBER_OF_BINS
    feature_thresholds: dict = field(default_factory=lambda: dict(FEATURE_DRIFT_THRESHOLDS))
    feature_weights: dict = field(default_factory=lambda: dict(FEATURE_METRIC_WEIGHTS))
    prediction_thresholds: dict = field(default_factory=lambda: dict(PREDICTION_DRIFT_THRESHOLDS))
    quality_thresholds: dict = field(default_factory=lambda: dict(DATA_QUALITY_THRESHOLDS))
    health_weights: dict = field(default_factory=lambda: dict(HEALTH_WEIGHTS))
    minimum_current_rows: int = MINIMUM_CURRENT_ROWS
    minimum_reference_rows: int = MINIMUM_REFERENCE_ROWS

"""Operators: each takes a DataFrame and returns a lazy DataFrame (or a bounded value)."""

from cohortlab.operators.encode import encode_categoricals
from cohortlab.operators.explore import (chart_series_missing, chart_series_prediction,
                                         chart_series_target, prediction_by, prediction_counts,
                                         target_by)
from cohortlab.operators.impute import apply_medians, fit_medians, impute_median
from cohortlab.operators.median import column_stats, exact_medians
from cohortlab.operators.missing import missing_counts
from cohortlab.operators.profile import describe, head_rows, profile, schema_rows

__all__ = [
    "encode_categoricals", "chart_series_missing", "chart_series_prediction", "chart_series_target",
    "prediction_by", "prediction_counts", "target_by", "apply_medians",
    "fit_medians", "impute_median", "column_stats", "exact_medians", "missing_counts",
    "describe", "head_rows", "profile", "schema_rows",
]

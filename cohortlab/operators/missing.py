"""Missing-value counting in one scan for all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_missing)`` for every column, missing meaning null (NaN is a value).

    One aggregate over the scan (partial counts per task, one tiny merge), then an
    ``unpivot`` of the single result row -- instead of one filter+count job per
    column.
    """
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_missing")

"""Median imputation: fit medians on one frame, apply them to any frame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortlab.operators.median import check_numeric, column_stats, exact_medians


def fit_medians(df: DataFrame, cols: Sequence[str] | None = None, exclude: Iterable[str] = (),
                only_needed: bool = False) -> dict[str, float]:
    """Exact lower median of each column.

    ``only_needed=True`` leaves out columns without a gap in ``df``: right for
    filling ``df`` itself, not for another frame, whose gaps may be elsewhere.
    Raises one error naming every string column (before any job) and every
    column without a single value.
    """
    skip = set(exclude)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in skip]
    check_numeric(df, cols)
    stats = column_stats(df, cols)
    if only_needed:
        cols = [c for c in cols if stats[c].nulls + stats[c].nans > 0]
    medians = exact_medians(df, cols, stats)
    empty = [c for c, m in medians.items() if m is None]
    if empty:
        raise ValueError(f"cannot impute: no non-missing value in column(s) {empty}")
    return medians


def apply_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Replace null (and NaN in float columns) by the column's median.

    One projection for all columns. An integer column receives the median cast
    to its type (2.9 -> 2), as a fill does.
    """
    if not medians:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    values = {}
    for c, m in medians.items():
        if c not in types:
            continue
        if isinstance(types[c], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            values[c] = int(m)
        else:
            values[c] = float(m)
    return df.na.fill(values) if values else df


def impute_median(df: DataFrame, cols: Sequence[str] | None = None,
                  exclude: Iterable[str] = ()) -> DataFrame:
    """Fill every column with its own exact median."""
    return apply_medians(df, fit_medians(df, cols, exclude, only_needed=True))

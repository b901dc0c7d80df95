"""Profiles: schema rows, summary statistics, a deterministic head."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.operators.median import NUMERIC


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(column, type, nullable)`` -- the printed schema as a table (no job)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max of every column as text (one aggregate)."""
    return df.describe(*(cols or []))


def profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Numeric summary in long form: ``column, count, mean, stddev, min, max``.

    Each row is stacked into ``(column, value)`` pairs inside the scan stage and
    aggregated by column: five small aggregates with map-side partial buffers
    and a shuffle of one row per column and task, instead of one aggregate with
    five expressions per column (whose generated code grows with the column
    count). ``count`` skips nulls; mean and sample stddev are rounded to
    ``digits`` so different summation orders agree.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (cols or df.columns) if isinstance(types[c], NUMERIC)]
    args = [x for c in cols for x in (F.lit(c), F.col(c).cast("double"))]
    pairs = df.select(F.stack(F.lit(len(cols)), *args).alias("column", "x"))
    return pairs.groupBy("column").agg(
        F.count("x").alias("count"), F.round(F.avg("x"), digits).alias("mean"),
        F.round(F.stddev_samp("x"), digits).alias("stddev"), F.min("x").alias("min"),
        F.max("x").alias("max"))


def profile_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Text-column summary in long form: ``column, count, min, max`` (one aggregate)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (cols or df.columns) if isinstance(types[c], T.StringType)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
    args = [x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"n{i}"), F.col(f"min{i}"), F.col(f"max{i}"))]
    return df.agg(*aggs).select(F.stack(F.lit(len(cols)), *args).alias("column", "count", "min", "max"))


def head_rows(df: DataFrame, n: int = 30, key: str = "id") -> DataFrame:
    """The first ``n`` rows by ``key``: a per-task top-n, then one bounded merge."""
    return df.orderBy(key).limit(n)

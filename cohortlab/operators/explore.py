"""Label and prediction break-downs by key, the prediction histogram, and
chart-ready long tables (``chart, category, series, n``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.encode import sex_label, smoking_label
from cohortlab.functions.keys import category_text
from cohortlab.schema import (EXPLORE_KEYS, GENDER_LABEL, LABEL, MISSING_SERIES, PREDICTION,
                              PREDICTION_COUNT, PREDICTION_ONE, PREDICTION_SERIES, PREDICTION_ZERO, TARGET_SERIES, TOTAL)


def _is(c: str, value: int) -> Column:
    return F.when(F.col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def target_by(df: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """``key, TenYearCHD, Total`` per key value, ordered by key.

    ``TenYearCHD`` counts positive labels; ``Total`` is ``count(key)``, so a
    null key group reports ``Total = 0``. A hash aggregate with map-side
    partial counts: a key holding a third of all rows is pre-aggregated in
    every task and never gathered. Keyed by ``sex`` it adds ``GenderLabel``.
    """
    out = df.groupBy(key).agg(F.sum(_is(label, 1)).alias(label), F.count(F.col(key)).alias(TOTAL))
    if key == "sex":
        out = out.withColumn(GENDER_LABEL, sex_label(F.col("sex")))
    return out.orderBy(key)


def prediction_by(df: DataFrame, key: str, prediction: str = PREDICTION) -> DataFrame:
    """``key, prediction_1, prediction_0, Total`` per key value, ordered by key."""
    return (df.groupBy(key)
            .agg(F.sum(_is(prediction, 1)).alias(PREDICTION_ONE),
                 F.sum(_is(prediction, 0)).alias(PREDICTION_ZERO),
                 F.count(F.col(key)).alias(TOTAL))
            .orderBy(key))


def _grouped(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """One grouping-sets aggregate, a set per key: keys, named ``aggs``, ``__n<i>`` (count of key i), ``__gid``."""
    counts = [F.count(F.col(k)).alias(f"__n{i}") for i, k in enumerate(keys)]
    named = [c.alias(name) for name, c in aggs.items()]
    return df.groupingSets([[k] for k in keys], *keys).agg(*named, *counts, F.grouping_id().alias("__gid"))


def _by_each_key(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
                 shape) -> tuple[dict[str, DataFrame], DataFrame]:
    """Per-key tables from one grouping-sets aggregate over all keys.

    The aggregate (one scan, one shuffle) is small -- one row per key value --
    and is cached, so the per-key tables split it without scanning ``df`` again.
    Returns the tables and the cached aggregate (unpersist it when done).
    """
    n, full = len(keys), (1 << len(keys)) - 1
    g = _grouped(df, keys, aggs).persist(StorageLevel.MEMORY_AND_DISK)
    out = {}
    for i, k in enumerate(keys):
        part = g.filter(F.col("__gid") == F.lit(full - (1 << (n - 1 - i))))
        out[k] = shape(k, part.select(k, *aggs.keys(), F.col(f"__n{i}").alias(TOTAL))).orderBy(k)
    return out, g


def target_by_keys(df: DataFrame, keys: Sequence[str] = EXPLORE_KEYS,
                   label: str = LABEL) -> tuple[dict[str, DataFrame], DataFrame]:
    """``{key: target_by(df, key)}`` for all keys from a single scan of ``df``."""
    def shape(k, t):
        return t.withColumn(GENDER_LABEL, sex_label(F.col("sex"))) if k == "sex" else t
    return _by_each_key(df, keys, {label: F.sum(_is(label, 1))}, shape)


def prediction_by_keys(df: DataFrame, keys: Sequence[str] = EXPLORE_KEYS,
                       prediction: str = PREDICTION) -> tuple[dict[str, DataFrame], DataFrame]:
    """``{key: prediction_by(df, key)}`` for all keys from a single scan of ``df``."""
    return _by_each_key(df, keys, {PREDICTION_ONE: F.sum(_is(prediction, 1)),
                                   PREDICTION_ZERO: F.sum(_is(prediction, 0))},
                        lambda k, t: t.select(k, PREDICTION_ONE, PREDICTION_ZERO, "Total"))


def prediction_counts(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    """``prediction, prediction_count``: the histogram of predicted classes."""
    return df.groupBy(prediction).count().withColumnRenamed("count", PREDICTION_COUNT)


def _category(key: str, decode_smoking: bool) -> Column:
    if key == "sex":
        return sex_label(F.col(key))
    if key == "is_smoking" and decode_smoking:
        return smoking_label(F.col(key))
    return category_text(F.col(key))


def _per_key(g: DataFrame, keys: Sequence[str], names: Sequence[str], decode_smoking: bool) -> DataFrame:
    """``chart, category, total`` + the aggregates ``names`` for every key, from ``_grouped``: one scan.

    A grouping-sets aggregate (one set per key) expands each row once per key
    inside the scan stage, pre-aggregates per task, and shuffles once, instead
    of one scan and one shuffle per key. ``grouping_id`` tells the sets apart;
    ``total`` is ``count(key)`` of the set's own key (0 for a null key group).
    """
    n, full = len(keys), (1 << len(keys)) - 1

    def pick(values: list[Column]) -> Column:
        out = None
        for i, v in enumerate(values):
            cond = F.col("__gid") == F.lit(full - (1 << (n - 1 - i)))
            out = F.when(cond, v) if out is None else out.when(cond, v)
        return out

    return g.select(pick([F.lit(k) for k in keys]).alias("chart"),
                    pick([_category(k, decode_smoking) for k in keys]).alias("category"),
                    pick([F.col(f"__n{i}") for i in range(n)]).alias("total"),
                    *names)


def chart_series_target(df: DataFrame, keys: Sequence[str] = EXPLORE_KEYS,
                        label: str = LABEL, grouped: DataFrame | None = None) -> DataFrame:
    """Label counts per key value in long form, series ``TenYearCHD`` / ``Non TenYearCHD``.

    ``grouped`` is the aggregate of ``target_by_keys`` of the same rows and keys, if the caller has it."""
    pos, neg = TARGET_SERIES
    if grouped is None:
        grouped = _grouped(df, keys, {label: F.sum(_is(label, 1))})
    t = _per_key(grouped, keys, [label], decode_smoking=True)
    t = t.select("chart", "category", F.col(label).alias(pos), (F.col("total") - F.col(label)).alias(neg))
    return t.unpivot(["chart", "category"], [pos, neg], "series", "n")


def chart_series_prediction(df: DataFrame, keys: Sequence[str] = EXPLORE_KEYS,
                            prediction: str = PREDICTION, grouped: DataFrame | None = None) -> DataFrame:
    """Prediction counts per key value in long form, series ``Prediction_1`` / ``Prediction_0``.

    Smoking categories are the encoded value, ``1`` / ``0`` (the label chart has ``YES`` / ``NO``).
    ``grouped`` is the aggregate of ``prediction_by_keys`` of the same rows and keys, if the caller has it."""
    one, zero = PREDICTION_SERIES
    if grouped is None:
        grouped = _grouped(df, keys, {PREDICTION_ONE: F.sum(_is(prediction, 1)),
                                      PREDICTION_ZERO: F.sum(_is(prediction, 0))})
    t = _per_key(grouped, keys, [PREDICTION_ONE, PREDICTION_ZERO], decode_smoking=False)
    t = t.select("chart", "category", F.col(PREDICTION_ONE).alias(one), F.col(PREDICTION_ZERO).alias(zero))
    return t.unpivot(["chart", "category"], [one, zero], "series", "n")


def chart_series_missing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing counts per column before and after imputation, in long form.

    ``before`` / ``after`` are ``(column, n_missing)`` frames."""
    b, a = MISSING_SERIES
    return _union([
        m.select(F.lit("missing").alias("chart"), F.col("column").alias("category"),
                 F.lit(series).alias("series"), F.col("n_missing").alias("n"))
        for m, series in ((before, b), (after, a))
    ])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

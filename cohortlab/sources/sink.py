"""Prediction export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlab.schema import EXPORT_COLUMNS


def export_projection(scored: DataFrame) -> DataFrame:
    """id, the 15 features and the prediction; no vectors, no label."""
    return scored.select(*EXPORT_COLUMNS)


def write_predictions(scored: DataFrame, path: str, single_file: bool = False,
                      fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write the export projection with a header.

    The default writes one file per partition, so scoring and writing stay
    parallel. ``single_file=True`` adds a shuffle to one partition *after*
    scoring (``repartition(1)``), instead of ``coalesce(1)``, which would pull
    the whole scoring plan into one task. The default mode fails if the
    target exists.
    """
    out = export_projection(scored)
    if single_file:
        out = out.repartition(1)
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported export format: {fmt!r}")

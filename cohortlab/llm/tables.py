"""Intermediate tables in the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlab.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, written as Parquet under the shared folder and read again.

    Its lineage is the files, and Spark knows its true size before it plans a
    join with it: a broadcast below the session's threshold, a shuffle above.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def column_places(df: DataFrame) -> dict[str, str]:
    """`__c0`, `__c1`, ... by column name: under these names an operator's own columns clash with none of `df`."""
    return {c: f"__c{i}" for i, c in enumerate(df.columns)}


def free_names(df: DataFrame, *names: str) -> list[str]:
    """`names`, all with as many underscores before them as it takes for none to be a column of `df`."""
    taken, before = {c.lower() for c in df.columns}, ""
    while any((before + n).lower() in taken for n in names):
        before += "_"
    return [before + n for n in names]

"""Profiles and missing counts gathered while a frame is computed for another purpose.

``DataFrame.observe`` adds aggregates to a plan that ride along with whatever
the frame is written or persisted for, so a report costs no scan of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.operators.median import NUMERIC


class Watch:
    """The counts of every column of ``df``: count, mean, sample stddev, min and max of
    numbers, count, min and max of texts. ``frame`` is ``df`` with the aggregates attached.

    The numbers are there once ONE action has computed the frame whole. Let that
    action be a write without a shuffle: its tasks are result tasks, and each partition's numbers
    count once even if a task is run again. A shuffle's map tasks give no such
    promise. Observe in a session of its own (``observing_session``).

    ``above`` is the watch of the frame that ``df`` was made of, row by row, with new values only in the
    columns ``changed`` and in those of another type: these are watched again, the others have the numbers of ``above``.
    """

    def __init__(self, df: DataFrame, spark: SparkSession | None = None, above: Watch | None = None,
                 changed: Iterable[str] = ()):
        self.spark = spark or df.sparkSession   # of the tables made from the numbers
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.above, again = above, set(changed)
        self._place = {c: i for i, (c, t) in enumerate(self.types.items())
                       if above is None or c in again or above.types.get(c) != t}   # of the columns watched here
        self._observation = Observation(f"watch-{uuid.uuid4().hex}")
        self._values: dict | None = None
        aggs = [F.count(F.lit(1)).alias("rows")]
        for c, i in self._place.items():
            x, t = F.col(f"`{c}`"), self.types[c]
            aggs.append(F.count(x).alias(f"count{i}"))
            if isinstance(t, NUMERIC):
                x = x.cast("double")
                aggs += [F.sum(x).alias(f"sum{i}"), F.stddev_samp(x).alias(f"stddev{i}")]
            if isinstance(t, (*NUMERIC, T.StringType)):
                aggs += [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        self.frame = df.observe(self._observation, *aggs)

    def _value(self, what: str, column: str | None = None, empty=None):
        if column is not None and column not in self._place:
            return self.above._value(what, column, empty)
        if self._values is None:
            self._values = self._observation.get
        return self._values.get(what if column is None else f"{what}{self._place[column]}", empty)

    def _mean(self, column: str) -> float | None:
        total = self._value("sum", column)
        return None if total is None else total / self._value("count", column)

    def profile(self, digits: int = 6) -> DataFrame:
        """As ``profile``: ``column, count, mean, stddev, min, max`` of the numeric columns."""
        def rounded(v):
            return None if v is None else round(v, digits)
        rows = [(c, self._value("count", c, 0), rounded(self._mean(c)), rounded(self._value("stddev", c)),
                 self._value("min", c), self._value("max", c))
                for c, t in self.types.items() if isinstance(t, NUMERIC)]
        return self.spark.createDataFrame(
            rows, "column string, count long, mean double, stddev double, min double, max double")

    def profile_text(self) -> DataFrame:
        """As ``profile_text``: ``column, count, min, max`` of the text columns."""
        rows = [(c, self._value("count", c, 0), self._value("min", c), self._value("max", c))
                for c, t in self.types.items() if isinstance(t, T.StringType)]
        return self.spark.createDataFrame(rows, "column string, count long, min string, max string")

    def missing(self) -> DataFrame:
        """As ``missing_counts``: ``column, n_missing`` of every column."""
        rows = [(c, self._value("rows", empty=0) - self._value("count", c, 0)) for c in self.types]
        return self.spark.createDataFrame(rows, "column string, n_missing long")

"""The prepare step: encode, count missing, impute with exact medians.

Three scans before the filled frame exists, whatever the column count: one
aggregate with the null and NaN counts of every column, a distinct estimate of
the columns with gaps alone, then their median search -- for columns with few
distinct values one grouped pass; near-unique columns add a sketch scan per
narrowing round. The reports (profiles, missing-after) are lazy frames the
caller can run or skip.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from cohortlab.operators.encode import encode_categoricals
from cohortlab.operators.impute import apply_medians, fit_medians
from cohortlab.operators.median import check_numeric, column_stats, exact_medians
from cohortlab.operators.missing import missing_counts
from cohortlab.operators.observe import Watch
from cohortlab.operators.profile import profile, profile_text
from cohortlab.schema import FEATURES


@dataclass
class Prepared:
    raw: DataFrame
    encoded: DataFrame
    frame: DataFrame                 # encoded and imputed
    missing_before: DataFrame        # (column, n_missing) of the encoded frame
    medians: dict[str, float]        # of the columns that were filled
    watches: tuple[Watch, Watch, Watch] | None = None   # of raw, encoded and frame, see observed()

    def medians_for_other(self, cols: Iterable[str] = FEATURES) -> dict[str, float]:
        """A median of every model column, for filling another file (or a stream):
        its gaps may lie in columns that have none here."""
        more = [c for c in cols if c in self.encoded.columns and c not in self.medians]
        return self.medians | (fit_medians(self.encoded, more) if more else {})

    def observed(self, spark: SparkSession | None = None) -> "Prepared":
        """The same step whose ``frame`` gathers the report's counts while it is computed.

        After one write of the frame (or of what is made of it row by row) the reports
        below read them; before that they would wait. The reports are tables of the
        session ``spark``, if given. See ``Watch``.
        """
        raw = Watch(self.raw, spark)
        encoded = Watch(encode_categoricals(raw.frame), spark, raw)
        frame = Watch(apply_medians(encoded.frame, self.medians), spark, encoded, self.medians)
        return replace(self, frame=frame.frame, watches=(raw, encoded, frame))

    def missing(self) -> DataFrame:
        """Missing counts of the encoded frame, before filling."""
        return self.watches[1].missing() if self.watches else self.missing_before

    def missing_after(self) -> DataFrame:
        return self.watches[2].missing() if self.watches else missing_counts(self.frame)

    def raw_missing(self) -> DataFrame:
        """Missing counts before encoding (encoding turns a missing sex into 0)."""
        return self.watches[0].missing() if self.watches else missing_counts(self.raw)

    def profile_before(self) -> DataFrame:
        return self.watches[0].profile() if self.watches else profile(self.raw)

    def profile_text(self) -> DataFrame:
        return self.watches[0].profile_text() if self.watches else profile_text(self.raw)

    def profile_after(self) -> DataFrame:
        return self.watches[2].profile() if self.watches else profile(self.frame)


def prepare(df: DataFrame, medians: dict[str, float] | None = None,
            exclude: Iterable[str] = (), persist: bool = False) -> Prepared:
    """Encode -> count missing -> fill with medians.

    ``medians=None`` fits them on ``df`` itself (each file with its own
    medians); pass a training file's ``Prepared.medians_for_other()`` to fill another
    file with them. Every column except ``exclude`` is imputed, so a string
    column left after encoding is an error, raised before any job runs.
    ``persist``: see ``exact_medians``; for text sources.
    """
    spark = df.sparkSession
    skip = set(exclude)
    encoded = encode_categoricals(df)
    cols = [c for c in encoded.columns if c not in skip]
    check_numeric(encoded, cols)
    if medians is not None:
        # Nothing to fit: the whole step stays lazy (the report is an aggregate
        # that runs only if it is used).
        return Prepared(df, encoded, apply_medians(encoded, medians),
                        missing_counts(encoded, cols), dict(medians))
    stats = column_stats(encoded, cols)                           # scan 1 (one bounded row)
    missing_before = spark.createDataFrame(
        [(c, int(stats[c].nulls)) for c in cols], "column string, n_missing long")
    need = [c for c in cols if stats[c].nulls + stats[c].nans > 0]
    medians = exact_medians(encoded, need, stats, persist=persist)                 # the columns with gaps only
    empty = [c for c, m in medians.items() if m is None]
    if empty:
        raise ValueError(f"cannot impute: no non-missing value in column(s) {empty}")
    frame = apply_medians(encoded, medians)
    return Prepared(df, encoded, frame, missing_before, medians)

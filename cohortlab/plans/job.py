"""The batch job: train file + file to score -> hold-out metrics, model, exported predictions.

    spark-submit --py-files cohortlab.zip cohortlab/plans/job.py TRAIN TEST OUT [--format csv|parquet] ...

The session comes from the submitter (no master is set here).
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession

from cohortlab.operators.explore import (chart_series_missing, chart_series_prediction, chart_series_target,
                                         prediction_by, prediction_by_keys, prediction_counts,
                                         target_by, target_by_keys)
from cohortlab.operators.model import cv_grid_metrics, fit_cv, holdout_metrics, linear_model, with_linear_score
from cohortlab.plans.prepare import Prepared, prepare
from cohortlab.schema import EXPLORE_KEYS, PATIENT_SCHEMA, SCORED_SCHEMA
from cohortlab.session import scratch_path
from cohortlab.sources.files import load_train_test, read_patients
from cohortlab.sources.sink import export_projection, write_predictions


REPORT = "_report"   # below the export; the underscore hides it from readers of the export


@dataclass
class JobResult:
    train: Prepared
    test: Prepared
    holdout: dict                    # n, accuracy, tp, tn, fp, fn on the hold-out part
    model: CrossValidatorModel
    predictions: DataFrame           # the exported rows, read back as they are needed
    report_tables: list = field(default_factory=list)   # names of the tables written
    _cached: list = field(default_factory=list)
    _grouped: dict = field(default_factory=dict)   # the aggregates of the two sets of tables

    def prediction_counts(self) -> DataFrame:
        return prediction_counts(self.predictions)

    def target_by(self, key: str) -> DataFrame:
        return target_by(self.train.frame, key)

    def prediction_by(self, key: str) -> DataFrame:
        return prediction_by(self.predictions, key)

    def target_tables(self) -> dict[str, DataFrame]:
        """The six label tables from one scan of the training rows."""
        tables, base = target_by_keys(self.train.frame, EXPLORE_KEYS)
        self._cached.append(base)
        self._grouped["target"] = base
        return tables

    def prediction_tables(self) -> dict[str, DataFrame]:
        """The six prediction tables from one scan of the exported rows."""
        tables, base = prediction_by_keys(self.predictions, EXPLORE_KEYS)
        self._cached.append(base)
        self._grouped["prediction"] = base
        return tables

    def target_charts(self) -> DataFrame:
        """Its series, from the label tables' scan if they were made."""
        return chart_series_target(self.train.frame, EXPLORE_KEYS, grouped=self._grouped.get("target"))

    def prediction_charts(self) -> DataFrame:
        """Its series, from the prediction tables' scan if they were made."""
        return chart_series_prediction(self.predictions, EXPLORE_KEYS, grouped=self._grouped.get("prediction"))

    def report(self) -> dict[str, DataFrame]:
        """Every table of the analysis, whole, by name."""
        out = {}
        for name, p in (("train", self.train), ("scored", self.test)):
            missing, missing_after = p.missing(), p.missing_after()
            out |= {f"{name}_profile_before": p.profile_before(), f"{name}_profile_text": p.profile_text(),
                    f"{name}_missing_before": missing, f"{name}_missing_after": missing_after,
                    f"{name}_profile_after": p.profile_after(),
                    f"{name}_chart_missing": chart_series_missing(missing, missing_after)}
        out |= {f"target_by_{k}": t for k, t in self.target_tables().items()}
        out |= {f"prediction_by_{k}": t for k, t in self.prediction_tables().items()}
        return out | {"chart_target": self.target_charts(), "chart_prediction": self.prediction_charts(),
                      "prediction_counts": self.prediction_counts(),
                      "grid_accuracy": cv_grid_metrics(self.predictions.sparkSession, self.model),
                      "holdout": self.predictions.sparkSession.createDataFrame([self.holdout])}

    def release(self) -> None:
        self._grouped.clear()
        while self._cached:
            self._cached.pop().unpersist()


def write_report(result: JobResult, path: str) -> list[str]:
    """Each report table as CSV under ``path``, all rows; their names."""
    tables = result.report()
    for name, table in tables.items():
        table.write.option("header", True).csv(f"{path}/{name}")
    return list(tables)


def read_report(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """The written report tables, as text."""
    return {name: spark.read.option("header", True).csv(f"{path}/{name}") for name in names}


def observing_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for plans that are observed.

    Observing gives a session a part that cannot be sent to executors, and a model fitted by MLlib in that
    session can then no longer transform rows; so the caller's session observes nothing.
    """
    session = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            session.conf.set(k, v)
    return session


def _stored(frame: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """``frame``, computed once into a Parquet table of the shared folder and read in ``spark``."""
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def run_job(spark: SparkSession, train_path: str, test_path: str, out_path: str,
            fmt: str = "csv", explicit_schema: bool = False, test_medians: str = "self",
            holdout: str = "hash", parallelism: int = 6, single_file: bool = False,
            report: bool = True, joint_schema: bool = False) -> JobResult:
    """Prepare both files, measure on a hold-out, fit on all training rows, score,
    export, and write the whole analysis to ``out_path/_report``.

    ``test_medians="self"`` fills the scored file with its own medians (the
    original behaviour); ``"train"`` uses the training medians. ``holdout="random"``
    is the original's random split, ``"exact"`` a reproducible one of exactly 70 %.
    ``joint_schema`` reads both files with one type per column.

    After ``prepare`` each input is scanned once: the training rows into a Parquet table
    of the shared folder, from which all else reads its columns, the scored rows into the export
    (through such a table if that is one file). The report's profiles and missing counts are
    gathered on the way.
    """
    schema = PATIENT_SCHEMA if explicit_schema else None
    test_schema = SCORED_SCHEMA if explicit_schema else None
    train_raw, test_raw = load_train_test(observing_session(spark), train_path, test_path, fmt, schema, test_schema, joint_schema)
    text = fmt == "csv"   # a sketch round would parse the whole file again
    train = prepare(train_raw, persist=text)
    test = prepare(test_raw, medians=train.medians_for_other() if test_medians == "train" else None,
                   persist=text)
    train, test = train.observed(spark), test.observed(spark)
    spark.createDataFrame([], "nothing int")   # makes the caller's session the thread's active one again
    result = JobResult(train, test, {}, None, None)
    try:
        train.frame = _stored(train.frame, spark, "prepared-train")
        metrics_df, _ = holdout_metrics(train.frame, split=holdout, parallelism=parallelism)
        result.holdout = metrics_df.first().asDict()

        result.model = fit_cv(train.frame, parallelism=parallelism)
        if single_file:
            test.frame = _stored(test.frame, spark, "prepared-scored")
        scored = with_linear_score(test.frame, linear_model(result.model))
        write_predictions(scored, out_path, single_file=single_file)
        result.predictions = read_patients(spark, out_path, schema=export_projection(scored).schema)
        if report:
            result.report_tables = write_report(result, f"{out_path}/{REPORT}")
    except BaseException:
        result.release()
        raise
    return result


class _Parser(argparse.ArgumentParser):
    def error(self, message):
        """Wrong or missing arguments: usage and exit status 1."""
        self.print_usage(sys.stderr)
        self.exit(1, f"{self.prog}: error: {message}\n")


def main(argv: list[str] | None = None) -> int:
    ap = _Parser(prog="cohortlab", description=__doc__.splitlines()[0])
    ap.add_argument("train")
    ap.add_argument("test")
    ap.add_argument("out")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--explicit-schema", action="store_true")
    ap.add_argument("--joint-schema", action="store_true", help="one inferred type per column for both files")
    ap.add_argument("--test-medians", default="self", choices=["self", "train"])
    ap.add_argument("--holdout", default="hash", choices=["hash", "random", "exact"])
    ap.add_argument("--parallelism", type=int, default=6)
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--no-report", action="store_true", help="don't write the analysis tables")
    ap.add_argument("--report", action="store_true", help="also print the analysis tables, all rows")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cohortlab").getOrCreate()
    res = run_job(spark, args.train, args.test, args.out, args.format, args.explicit_schema,
                  args.test_medians, args.holdout, args.parallelism, args.single_file, not args.no_report,
                  args.joint_schema)
    try:
        print(f"hold-out accuracy: {res.holdout['accuracy']:.4f} ({res.holdout})")
        if args.report:
            tables = (read_report(spark, f"{args.out}/{REPORT}", res.report_tables) if res.report_tables
                      else res.report())
            for name, table in tables.items():
                print(f"-- {name}\n{','.join(table.columns)}")
                for row in table.toLocalIterator():
                    print(*row, sep=",")
        else:
            for row in res.prediction_counts().toLocalIterator():
                print(f"prediction {row['prediction']:g}: {row['prediction_count']}")
    finally:
        res.release()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Print the physical plans of the main operators (``explain("formatted")``).

    python tools_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys

from pyspark.sql import functions as F

from cohortlab.operators.explore import chart_series_target, prediction_by, target_by, target_by_keys
from cohortlab.operators.profile import profile
from cohortlab.operators.missing import missing_counts
from cohortlab.operators.median import _Band, _State, finish_frame, sketch_frame, stats_frame
from cohortlab.operators.model import (FOLD, LinearModel, assembler, scaler, with_folds,
                                       with_linear_score)
from cohortlab.plans.prepare import prepare
from cohortlab.schema import EXPORT_COLUMNS, FEATURES, ID, LABEL
from cohortlab.session import local_session
from cohortlab.sources.fixtures import scored_patients, train_patients


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().strip()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    train = prepare(train_patients(spark, sf_dir))
    test = prepare(scored_patients(spark, sf_dir))
    lm = LinearModel(FEATURES, tuple(0.01 * (i + 1) for i in range(len(FEATURES))), -1.0)
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    prices = lineitem.select(F.col("l_extendedprice").cast("double").alias("__v0"))
    n = prices.count()
    search = {"__v0": _State(_Band(), (n + 1) // 2, n, margin=0.01)}

    def fold():
        rows = with_folds(train.frame.select(ID, *FEATURES, LABEL))
        part = assembler().transform(rows).select(LABEL, "features", FOLD).where(F.col(FOLD) != 0)
        return scaler().fit(part).transform(part).select(LABEL, "scaledFeatures")

    shown = {
        "stats scan -- the first pass of `prepare`: plain counts, one row": lambda: stats_frame(
            train.encoded, train.encoded.columns),
        "sketch round -- one column's band: exact counts and a KLL sketch, merged in two levels":
            lambda: sketch_frame(prices, search, 2048, 4),
        "finish -- rows grouped by value, a running count over that bounded set":
            lambda: finish_frame(prices, search),
        "one fold's training rows -- assembled, scaled by the fold's scaler, then persisted for six fits": fold,
        "target_by(prepared, 'age') -- fill folded into the scan projection, partial/final hash "
        "aggregate, range sort of the small result": lambda: target_by(train.frame, "age"),
        "chart_series_target -- six group-bys as one grouping-sets aggregate (one scan, one shuffle)":
            lambda: chart_series_target(train.frame),
        "missing_counts -- one aggregate for all columns, then an unpivot of one row":
            lambda: missing_counts(train.encoded),
        "profile -- rows stacked to (column, value) in the scan stage, five aggregates by column":
            lambda: profile(train.frame),
        "score + export projection -- folded linear score, no vectors, one codegen stage, no shuffle":
            lambda: with_linear_score(test.frame, lm).select(*EXPORT_COLUMNS),
        "prediction_by(scored, 'BPMeds')": lambda: prediction_by(with_linear_score(test.frame, lm), "BPMeds"),
        "target_by_keys -- the six label tables' shared grouping-sets aggregate (cached, then split)":
            lambda: target_by_keys(train.frame)[1],
    }
    print("# Physical plans of the main operators\n")
    print(f"Generated by `python tools_plans.py {sf_dir}` (PySpark {spark.version}, AQE on; "
          "the plans are the pre-AQE form; the cache is emptied before each).\n")
    print(f"Medians filled in by `prepare` on the training file: `{train.medians}`\n")
    for title, make in shown.items():
        spark.catalog.clearCache()
        print(f"## {title}\n\n```\n{plan(make())}\n```\n")


if __name__ == "__main__":
    main(sys.argv)

"""Headline timings of the pipeline on the patient fixture.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each step is forced with an action that consumes its whole output. Before the
timed steps, one scan and one pipeline fit run untimed, so JVM start-up and JIT
compilation of the scan, aggregation and MLlib code paths are not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cohortlab.operators.explore import prediction_by_keys, prediction_counts, target_by_keys  # noqa: E402
from cohortlab.operators.median import exact_medians  # noqa: E402
from cohortlab.operators.model import (accuracy_metrics, fit_cv, hash_holdout, linear_model,  # noqa: E402
                                       pipeline, score, with_linear_score)
from cohortlab.plans.prepare import prepare  # noqa: E402
from cohortlab.schema import EXPLORE_KEYS  # noqa: E402
from cohortlab.session import local_session, scratch_path  # noqa: E402
from cohortlab.sources.fixtures import scored_patients, train_patients  # noqa: E402
from cohortlab.sources.sink import write_predictions  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # warm-up: JVM, codegen caches, file listing, MLlib code paths (not timed)
    train_patients(spark, sf_dir).agg(F.count(F.lit(1))).first()
    warm_pipe, warm_lr = pipeline()
    warm_pipe.fit(prepare(train_patients(spark, sf_dir)).frame, {warm_lr.maxIter: 5})

    def prep_train():
        p = prepare(train_patients(spark, sf_dir))
        p.frame = p.frame.cache()
        p.frame.count()
        return p

    train = timed("prepare_train", prep_train)
    test = timed("prepare_test", lambda: prepare(scored_patients(spark, sf_dir)))
    timed("missing_report", lambda: train.missing_after().collect())
    timed("profile", lambda: train.profile_after().collect())
    def by_keys(fn, df):
        tables, base = fn(df, EXPLORE_KEYS)
        out = [t.collect() for t in tables.values()]
        base.unpersist()
        return out

    timed("explore_6_keys", lambda: by_keys(target_by_keys, train.frame))

    def holdout():
        tr, te = hash_holdout(train.frame)
        m = fit_cv(tr)
        return accuracy_metrics(score(m, te)).first()

    def single_fit():
        tr, te = hash_holdout(train.frame)
        pipe, lr = pipeline()
        m = pipe.fit(tr, {lr.regParam: 0.01, lr.elasticNetParam: 0.0})
        return accuracy_metrics(score(m, te)).first()

    timed("single_fit_score_accuracy", single_fit)
    hold = timed("holdout_cv_fit_and_eval", holdout)
    model = timed("cv_fit_all_train", lambda: fit_cv(train.frame))

    def export():
        scored = with_linear_score(test.frame, linear_model(model)).cache()
        write_predictions(scored, scratch_path(spark, "bench-export"))
        prediction_counts(scored).collect()
        return scored

    scored = timed("score_and_export", export)
    timed("analyse_6_keys", lambda: by_keys(prediction_by_keys, scored))

    # (one of them near-unique, so the sketch-and-verify path runs).
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    timed("median_exact_lineitem_4cols", lambda: exact_medians(
        lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "holdout_accuracy": round(hold["accuracy"], 4),
    }))


if __name__ == "__main__":
    main()

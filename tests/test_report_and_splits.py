"""The observed report, joint schemas, the reproducible split, and metrics of many models at once."""

import math
import shutil
from collections import Counter

import pytest
from pyspark.sql import SparkSession, functions as F
from pyspark.sql import types as T

from cohortlab.operators.missing import missing_counts
from cohortlab.operators.model import (accuracies, accuracy_evaluator, assembler, best_params, cv_fold_metrics, exact_holdout,
                                       fit_cv, holdout_metrics, logistic, pipeline, scaler, score, with_folds)
from cohortlab.operators.observe import Watch
from cohortlab.operators.profile import profile, profile_text
from cohortlab.plans.job import JobResult, main, observing_session, run_job
from cohortlab.plans.prepare import Prepared, prepare
from cohortlab.sources.files import joint_schemas, load_train_test, wider_type
from cohortlab.sources.fixtures import scored_patients, train_patients
from conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- observed report ---------------------------------------------------------------

def test_watch_equals_the_scans(spark, tmp_out):
    session = observing_session(spark)
    df = session.createDataFrame([(1, 2.5, "b", None, True), (None, float("nan"), "a", None, None), (3, None, None, None, False)],
                                 "i int, x double, s string, none double, flag boolean")
    watch = Watch(df)
    watch.frame.repartition(1).select("i").write.parquet(f"{tmp_out}/w")   # all columns are watched, one is written
    plain = df.na.replace(float("nan"), None).count() and df
    assert rows(watch.missing()) == rows(missing_counts(plain))
    assert repr(rows(watch.profile())) == repr(rows(profile(plain))) and rows(watch.profile_text()) == rows(profile_text(plain))


def test_watch_above_is_not_watched_again(spark, tmp_out):
    session = observing_session(spark)
    df = session.createDataFrame([(1, 2.5, "b", None), (None, float("nan"), "a", None), (3, None, None, 4.0)],
                                 "i int, x double, s string, gap double")
    raw = Watch(df)
    coded = Watch(raw.frame.withColumn("s", (F.col("s") == "a").cast("int")), None, raw)
    full = Watch(coded.frame.na.fill({"gap": 7.0}), None, coded, ["gap"])
    assert (list(raw._place), list(coded._place), list(full._place)) == (["i", "x", "s", "gap"], ["s"], ["gap"])
    full.frame.write.parquet(f"{tmp_out}/w")
    for watch, plain in ((raw, df), (coded, df.withColumn("s", (F.col("s") == "a").cast("int"))),
                         (full, df.withColumn("s", (F.col("s") == "a").cast("int")).na.fill({"gap": 7.0}))):
        assert rows(watch.missing()) == rows(missing_counts(plain))
        assert repr(rows(watch.profile())) == repr(rows(profile(plain)))
    assert rows(raw.profile_text()) == rows(profile_text(df)) and not rows(full.profile_text())


def test_charts_share_the_tables_scan(spark):
    frame = spark.range(200).selectExpr(
        "cast(if(id = 7, null, 30 + id % 9) as int) age", "cast(id % 2 as int) sex", "cast(id % 3 = 0 as int) is_smoking", "70.0D + id % 5 heartRate",
        "cast(id % 4 as double) cigsPerDay", "cast(id % 11 = 0 as double) BPMeds", "cast(id % 6 = 0 as int) TenYearCHD")
    scored = frame.withColumn("prediction", (F.col("age") > 33).cast("double"))
    none = Prepared(frame, frame, frame, frame, {})
    res = JobResult(none, none, {}, None, scored)
    alone = rows(res.target_charts()), rows(res.prediction_charts())
    res.target_tables(), res.prediction_tables()
    try:
        for shared, want in zip((res.target_charts(), res.prediction_charts()), alone):
            assert rows(shared) == want and want
            assert "InMemoryTableScan" in shared._jdf.queryExecution().executedPlan().toString()
    finally:
        res.release()
    assert rows(res.target_charts()) == alone[0]


def test_watch_of_no_rows(spark, tmp_out):
    df = observing_session(spark).createDataFrame([], "i int, s string")
    watch = Watch(df)
    watch.frame.write.parquet(f"{tmp_out}/w")
    assert rows(watch.missing()) == [("i", 0), ("s", 0)]
    assert rows(watch.profile()) == [("i", 0, None, None, None, None)]


def test_report_needs_no_further_scan(spark, tmp_out):
    train_csv, test_csv = f"{tmp_out}/train", f"{tmp_out}/test"
    train_patients(spark, SF_SMALL).write.option("header", True).csv(train_csv)
    scored_patients(spark, SF_SMALL).write.option("header", True).csv(test_csv)
    res = run_job(spark, train_csv, test_csv, f"{tmp_out}/out", explicit_schema=True, report=False, holdout="exact")
    assert SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)
    want = {}
    for name, p in (("train", prepare(res.train.raw)), ("scored", prepare(res.test.raw))):
        want |= {f"{name}_profile_before": rows(p.profile_before()), f"{name}_profile_text": rows(p.profile_text()),
                 f"{name}_missing_before": rows(p.missing()), f"{name}_missing_after": rows(p.missing_after()),
                 f"{name}_profile_after": rows(p.profile_after())}
    assert all(want.values()) and any(n for _, n in want["scored_missing_before"])
    shutil.rmtree(train_csv), shutil.rmtree(test_csv)          # the inputs are gone: nothing scans them again
    report = res.report()
    assert {k: rows(report[k]) for k in want} == want and len(report) == 29
    assert all(t.count() for t in report.values())
    assert res.holdout["n"] == train_patients(spark, SF_SMALL).count() - train_patients(spark, SF_SMALL).count() * 7 // 10
    # the caller's session and the model are as without the report: MLlib can still transform
    assert score(res.model, prepare(scored_patients(spark, SF_SMALL)).frame).count() == res.predictions.count()
    assert all(t.sparkSession is spark for k, t in report.items() if "profile" in k or "missing" in k)
    res.release()


def test_printed_report_is_the_written_one(spark, tmp_out, capsys, monkeypatch):
    train_csv, test_csv = f"{tmp_out}/train", f"{tmp_out}/test"
    train_patients(spark, SF_SMALL).write.option("header", True).csv(train_csv)
    scored_patients(spark, SF_SMALL).write.option("header", True).csv(test_csv)
    from cohortlab.plans import job
    made, whole = [], job.JobResult.report
    monkeypatch.setattr(job.JobResult, "report", lambda self: made.append(1) or whole(self))
    assert main([train_csv, test_csv, f"{tmp_out}/out", "--joint-schema", "--report", "--single-file"]) == 0
    said = capsys.readouterr().out
    assert made == [1]
    assert said.count("-- ") == 29 and "\nglucose,0" in said and "-- holdout" in said


# ---- joint schema ------------------------------------------------------------------

def test_types_widen():
    i, l, d, s, b = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
    assert wider_type(i, l) == l and wider_type(d, i) == d and wider_type(l, d) == d and wider_type(i, i) == i
    assert wider_type(b, i) == s and wider_type(s, d) == s and wider_type(T.DateType(), T.TimestampType()) == T.TimestampType()


def test_two_files_meet_in_one_schema(spark, tmp_out):
    a, b = f"{tmp_out}/a.csv", f"{tmp_out}/b.csv"
    with open(a, "w") as f:
        f.write("id,x,gap,mixed,only\n1,2,,7,u\n2,,,8,v\n")
    with open(b, "w") as f:
        f.write("gap,id,mixed,x\n1.5,9000000000,n/a,0.25\n,4,9,3\n")
    one, two = load_train_test(spark, a, b, joint=True)
    assert dict(one.dtypes) == {"id": "bigint", "x": "double", "gap": "double", "mixed": "string", "only": "string"}
    assert dict(two.dtypes) == {"gap": "double", "id": "bigint", "mixed": "string", "x": "double"}
    assert rows(one) == [(1, 2.0, None, "7", "u"), (2, None, None, "8", "v")]
    assert rows(two) == [(1.5, 9_000_000_000, "n/a", 0.25), (None, 4, "9", 3.0)]
    apart = load_train_test(spark, a, b)                        # each file's own inference, as before
    assert dict(apart[0].dtypes)["x"] == "int" and dict(apart[1].dtypes)["x"] == "double"
    same = joint_schemas(one, one)
    assert same[0] == same[1]


# ---- exact split -------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 9, 10, 1000])
def test_exact_split_sizes_on_any_layout(spark, n):
    df = spark.range(n).withColumn("x", F.col("id") * 2)
    seen = set()
    for parts in (1, 4, 16):
        train, test = exact_holdout(df.repartition(parts))
        assert train.count() == n * 7 // 10 and train.count() + test.count() == n
        seen.add(repr(rows(train)))
        assert train.intersect(test).count() == 0
    assert len(seen) == 1


def test_exact_split_with_null_and_repeated_keys(spark):
    data = [(None, i % 3) for i in range(40)] + [(7, 1)] * 35 + [(i, 0) for i in range(25)] + [(7, None)]
    for seed in (1, 2, 3):
        seen = set()
        for parts in (1, 5):
            df = spark.createDataFrame(data, "id int, x int").repartition(parts)
            train, test = exact_holdout(df, seed=seed)
            got, rest = train.collect(), test.collect()
            assert len(got) == len(data) * 7 // 10
            assert Counter(map(tuple, got + rest)) == Counter(data)    # every row, as often as it is there
            seen.add(repr(sorted(map(tuple, got), key=repr)))
        assert len(seen) == 1
    everything, nothing = exact_holdout(spark.range(5), "1")
    assert everything.count() == 5 and nothing.count() == 0


# ---- cross-validation --------------------------------------------------------------

def test_models_of_a_fold_are_measured_in_one_scan(spark):
    frame = prepare(train_patients(spark, SF_SMALL)).frame
    data = assembler().transform(frame)
    scaled = scaler().fit(data).transform(data).select("TenYearCHD", "scaledFeatures").cache()
    lr = logistic()
    models = [lr.fit(scaled, {lr.regParam: r, lr.elasticNetParam: e}) for r, e in ((0.1, 0.0), (0.01, 1.0), (5.0, 1.0))]
    n, found = accuracies(scaled, models)
    assert n == frame.count()
    assert found == pytest.approx([accuracy_evaluator().evaluate(m.transform(scaled)) for m in models], abs=1e-15)
    models[0].setThreshold(0.2)
    assert accuracies(scaled, models[:1])[1][0] == pytest.approx(accuracy_evaluator().evaluate(models[0].transform(scaled)))
    none = accuracies(scaled.limit(0), models)
    assert none[0] == 0 and all(math.isnan(v) for v in none[1])


def test_fold_metrics_and_the_chosen_point(spark):
    frame = prepare(train_patients(spark, SF_SMALL)).frame
    model = fit_cv(frame, num_folds=3, reg_params=(0.1, 0.01), elastic_net_params=(0.0, 1.0), sub_models=True)
    table = cv_fold_metrics(spark, model)
    assert table.count() == 12 and len(model.subModels) == 3 and len(model.subModels[0]) == 4
    mean = {(r["regParam"], r["elasticNetParam"]): r["a"] for r in
            table.groupBy("regParam", "elasticNetParam").agg(F.avg("accuracy").alias("a")).collect()}
    assert sorted(mean.values()) == pytest.approx(sorted(model.avgMetrics))
    assert mean[best_params(model)] == max(mean.values())
    fold = with_folds(frame, num_folds=3).where("fold = 1")
    for m, r in zip(model.subModels[1], model.foldMetrics[1][1]):
        assert accuracy_evaluator().evaluate(score(m, fold)) == pytest.approx(r)


def test_a_fold_without_rows_is_an_error(spark):
    frame = prepare(train_patients(spark, SF_SMALL)).frame.where("((id % 1013) * 104729) % 1013 % 5 <> 2")
    with pytest.raises(ValueError, match="fold 2 has no rows"):
        fit_cv(frame, reg_params=(0.1,), elastic_net_params=(0.0,))


def test_exact_holdout_beats_the_majority(spark):
    m, _ = holdout_metrics(prepare(train_patients(spark, SF_SMALL)).frame, split="exact",
                           reg_params=(0.01,), elastic_net_params=(0.0,))
    r = m.first()
    assert r["accuracy"] >= max(r["tp"] + r["fn"], r["tn"] + r["fp"]) / r["n"] + 0.1

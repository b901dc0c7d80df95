import glob
import os

from pyspark.sql import functions as F

from cohortlab.operators.model import fit_cv, linear_model, pipeline, with_linear_score
from cohortlab.plans.job import main, run_job
from cohortlab.plans.prepare import prepare
from cohortlab.schema import EXPLORE_KEYS, EXPORT_COLUMNS, SCORED_SCHEMA
from cohortlab.sources.files import read_patients
from cohortlab.sources.fixtures import scored_patients, train_patients
from cohortlab.streaming.score import score_stream
from conftest import SF_SMALL


def fit_one(frame):
    pipe, lr = pipeline()
    return pipe.fit(frame, {lr.regParam: 0.01})


def test_stream_scoring_equals_batch(spark, tmp_out):
    train = prepare(train_patients(spark, SF_SMALL))
    model = fit_cv(train.frame)
    src = os.path.join(tmp_out, "incoming")
    scored_raw = scored_patients(spark, SF_SMALL)
    # two arriving files
    scored_raw.filter("id % 2 = 0").write.option("header", True).csv(os.path.join(src, "a"))
    scored_raw.filter("id % 2 = 1").write.option("header", True).csv(os.path.join(src, "b"))
    for sub in ("a", "b"):
        for f in glob.glob(os.path.join(src, sub, "part-*.csv")):
            os.rename(f, os.path.join(src, f"{sub}-{os.path.basename(f)}"))
    out, ckpt = os.path.join(tmp_out, "out"), os.path.join(tmp_out, "ckpt")
    q = score_stream(spark, model, train.medians_for_other(), src, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination(120)
    got = read_patients(spark, out, schema=with_linear_score(
        prepare(scored_raw, medians=train.medians_for_other()).frame, linear_model(model)).select(*EXPORT_COLUMNS).schema)
    want = with_linear_score(prepare(read_patients(spark, src, schema=SCORED_SCHEMA),
                                     medians=train.medians_for_other()).frame, linear_model(model)).select(*EXPORT_COLUMNS)
    assert got.count() == scored_raw.count()
    assert got.exceptAll(want).count() == 0


def test_run_job_end_to_end(spark, tmp_out):
    train_csv, test_csv = os.path.join(tmp_out, "train"), os.path.join(tmp_out, "test")
    train_patients(spark, SF_SMALL).write.option("header", True).csv(train_csv)
    scored_patients(spark, SF_SMALL).write.option("header", True).csv(test_csv)
    out = os.path.join(tmp_out, "pred")
    res = run_job(spark, train_csv, test_csv, out, explicit_schema=True, holdout="hash")
    n_test = scored_patients(spark, SF_SMALL).count()
    assert sum(r.prediction_count for r in res.prediction_counts().collect()) == n_test
    back = spark.read.option("header", True).csv(out)
    assert back.columns == list(EXPORT_COLUMNS) and back.count() == n_test
    assert 0.0 <= res.holdout["accuracy"] <= 1.0 and res.holdout["n"] > 0
    by_age = res.prediction_by("age").collect()
    assert sum(r.Total for r in by_age) == n_test
    tables = res.prediction_tables()
    assert tables["age"].collect() == by_age
    assert res.target_tables()["sex"].collect() == res.target_by("sex").collect()

    def written(name):
        return spark.read.option("header", True).csv(f"{out}/_report/{name}")
    for key in EXPLORE_KEYS:                                  # every group, not the first few
        assert written(f"target_by_{key}").count() == res.train.frame.select(key).distinct().count()
        assert written(f"prediction_by_{key}").count() == res.test.frame.select(key).distinct().count()
    assert written("target_by_heartRate").count() == 61 and written("target_by_age").count() == 39
    assert written("chart_target").count() == res.target_charts().count() > 2 * 61
    assert written("chart_prediction").count() == res.prediction_charts().count()
    for part, frame in (("train", res.train), ("scored", res.test)):
        n = len(frame.encoded.columns)
        assert written(f"{part}_missing_before").count() == written(f"{part}_missing_after").count() == n
        assert written(f"{part}_profile_after").count() == n and written(f"{part}_profile_before").count() == n - 2
        assert written(f"{part}_chart_missing").count() == 2 * n
    assert written("grid_accuracy").count() == 6 and written("holdout").count() == 1
    res.release()


def test_job_with_train_medians(spark, tmp_out):
    train_csv, test_csv = os.path.join(tmp_out, "train"), os.path.join(tmp_out, "test")
    train_patients(spark, SF_SMALL).write.option("header", True).csv(train_csv)
    gappy = scored_patients(spark, SF_SMALL).withColumn("diaBP", F.expr("if(id % 3 = 0, null, diaBP)"))
    gappy.write.option("header", True).csv(test_csv)
    out = os.path.join(tmp_out, "pred")
    res = run_job(spark, train_csv, test_csv, out, explicit_schema=True, test_medians="train", report=False)
    assert spark.read.option("header", True).csv(out).where("diaBP is null").count() == 0
    assert not os.path.exists(f"{out}/_report")
    res.release()


def test_cli_argument_check(capsys):
    import pytest
    for argv in ([], ["train.csv"], ["a", "b", "c", "--format", "xml"]):
        with pytest.raises(SystemExit) as e:
            main(argv)
        assert e.value.code == 1
    assert "usage" in capsys.readouterr().err


def test_cli_report(spark, tmp_out, capsys):
    train_csv, test_csv = os.path.join(tmp_out, "tr"), os.path.join(tmp_out, "te")
    train_patients(spark, SF_SMALL).write.option("header", True).csv(train_csv)
    scored_patients(spark, SF_SMALL).write.option("header", True).csv(test_csv)
    assert main([train_csv, test_csv, os.path.join(tmp_out, "o"), "--explicit-schema", "--report", "--no-report"]) == 0
    out = capsys.readouterr().out
    assert "hold-out accuracy" in out and "prediction_count" in out and "GenderLabel" in out
    rows = out.split("-- target_by_heartRate\n")[1].split("\n-- ")[0].splitlines()
    assert len(rows) == 1 + 61


def test_stream_rejects_what_it_cannot_score(spark, tmp_out):
    import pytest
    train = prepare(train_patients(spark, SF_SMALL))
    model = fit_one(train.frame)
    with pytest.raises(ValueError, match="sysBP"):
        score_stream(spark, model, train.medians, tmp_out, tmp_out, tmp_out)
    raw = scored_patients(spark, SF_SMALL)
    good = raw.withColumn("sysBP", F.expr("if(id % 4 = 0, null, sysBP)"))   # gaps the training file has not
    swapped = raw.select(*["diaBP" if c == "sysBP" else "sysBP" if c == "diaBP" else c for c in raw.columns])
    text = raw.withColumn("sysBP", F.lit("NA"))
    for name, df, fails in (("good", good, False), ("swapped", swapped, True), ("text", text, True)):
        src, out = os.path.join(tmp_out, name), os.path.join(tmp_out, f"{name}-out")
        df.write.option("header", True).csv(src)
        q = score_stream(spark, model, train.medians_for_other(), src, out, os.path.join(tmp_out, f"{name}-ckpt"))
        if fails:
            with pytest.raises(Exception):
                q.awaitTermination(120)
        else:
            q.awaitTermination(120)
            assert spark.read.option("header", True).csv(out).where("sysBP is null").count() == 0
    pq = os.path.join(tmp_out, "lacking")
    raw.drop("sysBP").write.parquet(pq)
    with pytest.raises(ValueError, match="sysBP"):
        score_stream(spark, model, train.medians_for_other(), pq, pq + "-out", pq + "-ckpt", fmt="parquet")


def test_stream_scoring_parquet_source(spark, tmp_out):
    train = prepare(train_patients(spark, SF_SMALL))
    pipe, lr = pipeline()
    model = pipe.fit(train.frame, {lr.regParam: 0.01})
    src = os.path.join(tmp_out, "pq-in")
    scored_raw = scored_patients(spark, SF_SMALL)
    scored_raw.write.parquet(src)
    out, ckpt = os.path.join(tmp_out, "pq-out"), os.path.join(tmp_out, "pq-ckpt")
    q = score_stream(spark, model, train.medians_for_other(), src, out, ckpt, fmt="parquet")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = with_linear_score(prepare(scored_raw, medians=train.medians_for_other()).frame,
                             linear_model(model)).select(*EXPORT_COLUMNS)
    assert got.columns == list(EXPORT_COLUMNS)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

from pyspark.sql import functions as F

from cohortlab.operators.explore import (chart_series_missing, chart_series_prediction,
                                         chart_series_target, prediction_by, prediction_counts,
                                         target_by)
from cohortlab.operators.missing import missing_counts


def test_missing_counts_one_pass_equals_per_column(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.0, None), (3, float("nan"), "c")],
                               "a int, b double, c string")
    got = {r["column"]: r["n_missing"] for r in missing_counts(df).collect()}
    want = {c: df.filter(F.col(c).isNull()).count() for c in df.columns}
    assert got == want == {"a": 1, "b": 1, "c": 1}          # NaN is not missing


def test_null_group_key_total_zero_and_order(spark):
    df = spark.createDataFrame([(None, 1), (1, 1), (1, 0)], "k int, TenYearCHD int")
    rows = target_by(df, "k").collect()
    assert [(r.k, r.TenYearCHD, r.Total) for r in rows] == [(None, 1, 0), (1, 1, 2)]


def test_target_by_sex_has_gender_label(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (0, 1)], "sex int, TenYearCHD int")
    rows = target_by(df, "sex").collect()
    assert [(r.sex, r.GenderLabel, r.TenYearCHD, r.Total) for r in rows] == [(0, "F", 1, 2), (1, "M", 1, 1)]


def test_prediction_by_sums_and_histogram(spark):
    df = spark.range(0, 1000).select((F.col("id") % 13).alias("age"),
                                     (F.col("id") % 3 == 0).cast("double").alias("prediction"))
    out = prediction_by(df, "age").collect()
    assert [r.age for r in out] == sorted(r.age for r in out)
    assert all(r.prediction_0 + r.prediction_1 == r.Total for r in out)
    assert sum(r.Total for r in out) == 1000
    hist = {r.prediction: r.prediction_count for r in prediction_counts(df).collect()}
    assert hist == {1.0: 334, 0.0: 666}


def test_chart_series_long_form(spark):
    df = spark.createDataFrame(
        [(50, 1, 1, 70.0, 0.0, 0.0, 1, 1.0), (50, 0, 0, 71.0, 5.0, 1.0, 0, 0.0), (60, 1, 0, 70.0, 0.0, 0.0, 0, 0.0)],
        "age int, sex int, is_smoking int, heartRate double, cigsPerDay double, BPMeds double, "
        "TenYearCHD int, prediction double")
    t = chart_series_target(df)
    assert set(t.columns) == {"chart", "category", "series", "n"}
    tot = {(r.chart): 0 for r in t.collect()}
    for r in t.collect():
        tot[r.chart] += r.n
    assert all(v == 3 for v in tot.values())
    cats = {(r.chart, r.category) for r in t.collect()}
    assert ("sex", "M") in cats and ("is_smoking", "NO") in cats and ("heartRate", "70.0") in cats
    assert ("age", "50") in cats
    p = chart_series_prediction(df).collect()
    assert {r.series for r in p} == {"Prediction_1", "Prediction_0"}
    m = chart_series_missing(missing_counts(df.select("age")), missing_counts(df.select("age"))).collect()
    assert {r.series for r in m} == {"Missing Data", "Missing Data (After)"}


def test_profile_schema_rows_describe_head(spark):
    from cohortlab.operators.profile import describe, head_rows, profile, schema_rows
    df = spark.createDataFrame([(3, 1.0, "a"), (1, None, "b"), (2, 3.0, None)], "id int, x double, s string")
    prof = {r["column"]: r for r in profile(df).collect()}
    assert set(prof) == {"id", "x"}
    assert (prof["x"]["count"], prof["x"]["mean"], prof["x"]["min"], prof["x"]["max"]) == (2, 2.0, 1.0, 3.0)
    assert prof["id"]["stddev"] == 1.0
    rows = {r.column: r.type for r in schema_rows(spark, df).collect()}
    assert rows == {"id": "int", "x": "double", "s": "string"}
    d = {r.summary: r for r in describe(df).collect()}
    assert d["count"]["s"] == "2" and d["mean"]["x"] == "2.0"
    assert [r.id for r in head_rows(df, 2).collect()] == [1, 2]


def test_column_stats_agree_with_missing_counts(spark):
    from cohortlab.operators.median import column_stats
    df = spark.createDataFrame([(1, None, 2.0), (None, float("nan"), 2.0), (3, 1.0, None), (3, 1.0, 5.0)],
                               "a int, b double, c double")
    st = column_stats(df, df.columns)
    miss = {r["column"]: r["n_missing"] for r in missing_counts(df).collect()}
    assert {c: st[c].nulls for c in df.columns} == miss == {"a": 1, "b": 1, "c": 1}
    assert (st["b"].nans, st["b"].valid, st["a"].valid, st["a"].rows) == (1, 2, 3, 4)
    assert (st["b"].rows, st["c"].valid, st["c"].nans) == (4, 3, 0)


def test_by_keys_equal_single_key_tables(spark):
    from cohortlab.operators.explore import prediction_by_keys, target_by_keys
    df = spark.createDataFrame(
        [(50, 1, 1, 70.0, 0.0, None, 1, 1.0), (50, 0, 0, 71.0, 5.0, 1.0, 0, 0.0),
         (None, 1, 0, 70.0, 0.0, 0.0, 0, 0.0), (60, 1, 0, 70.0, 0.0, 0.0, 1, 1.0)],
        "age int, sex int, is_smoking int, heartRate double, cigsPerDay double, BPMeds double, "
        "TenYearCHD int, prediction double")
    tables, base = target_by_keys(df)
    for k, t in tables.items():
        assert t.columns == target_by(df, k).columns
        assert t.collect() == target_by(df, k).collect()
    base.unpersist()
    tables, base = prediction_by_keys(df)
    for k, t in tables.items():
        assert t.columns == prediction_by(df, k).columns
        assert t.collect() == prediction_by(df, k).collect()
    base.unpersist()

import pytest
from pyspark.sql import functions as F

from cohortlab.operators.missing import missing_counts
from cohortlab.plans.prepare import prepare
from cohortlab.schema import FEATURES
from cohortlab.sources.fixtures import scored_patients, train_patients
from conftest import SF_SMALL


def sequential_reference(df):
    """Encode, then fill one column at a time with its exact median (the per-column loop)."""
    df = df.withColumn("sex", F.when(F.col("sex") == "M", 1).otherwise(0))
    df = df.withColumn("is_smoking", F.when(F.col("is_smoking") == "YES", 1).otherwise(0))
    for c in df.columns:
        med = df.stat.approxQuantile(c, [0.5], 0.0)[0]
        df = df.na.fill(med, [c])
    return df


def test_one_pass_equals_sequential(spark):
    raw = train_patients(spark, SF_SMALL)
    ours = prepare(raw).frame
    ref = sequential_reference(raw)
    assert ours.columns == ref.columns
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_missing_before_after(spark):
    p = prepare(train_patients(spark, SF_SMALL))
    before = {r["column"]: r["n_missing"] for r in p.missing_before.collect()}
    assert before["sex"] == 0 and before["is_smoking"] == 0         # encoded first
    assert before["age"] > 0 and before["glucose"] > 0
    raw = {r["column"]: r["n_missing"] for r in p.raw_missing().collect()}
    assert raw["sex"] > 0
    after = {r["column"]: r["n_missing"] for r in p.missing_after().collect()}
    assert set(after.values()) == {0}


def test_imputing_twice_is_once(spark):
    p = prepare(train_patients(spark, SF_SMALL))
    again = prepare(p.frame)
    assert again.medians == {}
    assert again.frame.exceptAll(p.frame).count() == 0


def test_train_medians_applied_to_test(spark):
    train = prepare(train_patients(spark, SF_SMALL))
    # gaps where the training file has none
    gappy = scored_patients(spark, SF_SMALL).withColumn("sysBP", F.expr("if(id % 4 = 0, null, sysBP)"))
    assert "sysBP" not in train.medians
    medians = train.medians_for_other()
    assert set(medians) == set(FEATURES)
    assert {c: medians[c] for c in train.medians} == train.medians
    with_train = prepare(gappy, medians=medians)
    assert missing_counts(with_train.frame).filter("n_missing > 0").count() == 0
    filled = with_train.frame.filter("id % 4 = 0").select("sysBP").distinct().collect()
    assert [r.sysBP for r in filled] == [train.encoded.stat.approxQuantile("sysBP", [0.5], 0.0)[0]]
    # fitted for the file itself, the same gaps stay: the scorer raises on them
    short = prepare(gappy, medians=train.medians)
    assert missing_counts(short.frame).filter("n_missing > 0").count() == 1


def test_string_column_rejected_before_any_job(spark):
    df = spark.createDataFrame([(1, "x")], "id int, note string")
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    with pytest.raises(ValueError, match="note"):
        prepare(df)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs_before


def test_result_independent_of_partitioning(spark):
    raw = train_patients(spark, SF_SMALL)
    base = prepare(raw)
    for p in (1, 4, 16):
        other = prepare(raw.repartition(p))
        assert other.medians == base.medians

from pyspark.sql import functions as F

from cohortlab.functions.encode import sex_label, smoking_label
from cohortlab.operators.encode import encode_categoricals


def test_encode_sex_exact_and_null(spark):
    df = spark.createDataFrame([(1, "M"), (2, "F"), (3, None), (4, "m")], "id int, sex string")
    got = [r.sex for r in encode_categoricals(df).orderBy("id").collect()]
    assert got == [1, 0, 0, 0]


def test_encode_smoking_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "YES"), (2, "Yes"), (3, "NO"), (4, None)], "id int, is_smoking string")
    out = encode_categoricals(df)
    assert dict(out.dtypes)["is_smoking"] == "int"
    assert [r.is_smoking for r in out.orderBy("id").collect()] == [1, 0, 0, 0]


def test_labels_decode(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "x int")
    rows = df.select(sex_label(F.col("x")).alias("s"), smoking_label(F.col("x")).alias("k")).collect()
    assert [(r.s, r.k) for r in rows] == [("M", "YES"), ("F", "NO"), ("F", "NO")]

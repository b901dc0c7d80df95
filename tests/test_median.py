import math
import random

import pytest
from pyspark.sql import functions as F

from cohortlab.operators.impute import apply_medians, fit_medians
from cohortlab.operators.median import exact_medians


def one_col(spark, values, dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def brute_lower_median(values):
    xs = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    return float(xs[(len(xs) + 1) // 2 - 1]) if xs else None


def test_lower_median_even_n(spark):
    assert exact_medians(one_col(spark, [1, 2, 3, 4], "int"), ["x"]) == {"x": 2.0}


def test_nulls_ignored(spark):
    assert exact_medians(one_col(spark, [1, 1, 2, 9, None, None], "int"), ["x"]) == {"x": 1.0}


def test_nan_ignored_and_filled(spark):
    df = one_col(spark, [1.0, float("nan"), None, 7.0])
    med = fit_medians(df)
    assert med == {"x": 1.0}
    filled = [r.x for r in apply_medians(df, med).collect()]
    assert filled == [1.0, 1.0, 1.0, 7.0]


def test_all_null_is_named_error(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, empty double")
    with pytest.raises(ValueError, match="empty"):
        fit_medians(df)


def test_string_column_is_named_error(spark):
    df = spark.createDataFrame([(1, "a")], "id int, txt string")
    with pytest.raises(ValueError, match="txt"):
        fit_medians(df)


def test_int_column_fill_truncates(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert [r.x for r in apply_medians(df, {"x": 2.9}).collect()] == [1, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force_with_sketch_rounds(spark, seed):
    rnd = random.Random(seed)
    n = 20000
    near_unique = [rnd.random() * 1e6 for _ in range(n)]
    hot = [0.0 if rnd.random() < 0.34 else float(rnd.randint(1, 5000)) for _ in range(n)]
    sparse = [None if rnd.random() < 0.5 else float(rnd.randint(-10**9, 10**9)) for _ in range(n)]
    df = spark.createDataFrame(list(zip(near_unique, hot, sparse)), "u double, hot double, sparse double")
    # a tiny finish threshold forces several sketch-and-verify rounds
    got = exact_medians(df.repartition(7), ["u", "hot", "sparse"], finish_distinct=50, sketch_k=64)
    assert got == {"u": brute_lower_median(near_unique), "hot": brute_lower_median(hot),
                   "sparse": brute_lower_median(sparse)}


def test_persisted_rounds_give_the_same_and_leave_no_cache(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 4999).cast("double").alias("v"))
    want = exact_medians(df, ["v"], finish_distinct=10, sketch_k=32)
    spark.catalog.clearCache()
    assert exact_medians(df, ["v"], finish_distinct=10, sketch_k=32, persist=True) == want
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_both_plans_agree_at_the_threshold(spark):
    for distinct in (99, 100, 101):
        df = spark.range(0, 1000).select((F.col("id") * 7919 % distinct).cast("double").alias("v"))
        want = {"v": brute_lower_median([float(i * 7919 % distinct) for i in range(1000)])}
        for threshold in (98, 99, 100, 101, 102, 999, 1000, 1001):
            assert exact_medians(df, ["v"], finish_distinct=threshold) == want


def test_only_columns_with_gaps_are_searched(spark, monkeypatch):
    import cohortlab.operators.median as median
    from cohortlab.plans.prepare import prepare
    seen = []
    monkeypatch.setattr(median, "_distinct_estimates", lambda base, names: seen.append(len(names)) or {})
    df = spark.range(0, 200).selectExpr("id", "'M' as sex", "'YES' as is_smoking", "if(id % 9 = 0, null, id) as age")
    assert set(prepare(df).medians) == {"age"}
    median.exact_medians(df, ["id", "age"], finish_distinct=10)
    assert seen == [0, 2]


def test_partition_layout_does_not_change_medians(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 4999).cast("double").alias("v"))
    want = exact_medians(df, ["v"])
    for p in (1, 4, 16):
        assert exact_medians(df.repartition(p), ["v"], finish_distinct=10, sketch_k=32) == want


def test_equals_spark_percentile_disc(spark):
    df = spark.range(0, 3001).select(((F.col("id") * 37) % 1001).alias("a"),
                                     (F.col("id") % 7).cast("double").alias("b"))
    want = df.select(*[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})").alias(c)
                       for c in ("a", "b")]).first().asDict()
    assert exact_medians(df, ["a", "b"]) == {k: float(v) for k, v in want.items()}

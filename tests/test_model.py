import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlab.operators.model import (accuracy_metrics, cv_grid_metrics, fit_cv, hash_holdout,
                                       linear_model, lr_coefficients, optimality, pipeline, score,
                                       with_folds, with_linear_score)
from cohortlab.plans.prepare import prepare
from cohortlab.schema import FEATURES, LABEL
from cohortlab.sources.fixtures import train_patients
from conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def prepared(spark):
    return prepare(train_patients(spark, SF_MID)).frame.cache()


def fit_one(df, reg, enet):
    pipe, lr = pipeline()
    return pipe.fit(df, {lr.regParam: reg, lr.elasticNetParam: enet})


def residual_gradients(model, df):
    out = model.transform(df).select(
        (vector_to_array("probability")[1] - F.col(LABEL)).alias("r"),
        vector_to_array("scaledFeatures").alias("z"))
    aggs = [F.avg("r").alias("g0")] + [F.avg(F.col("r") * F.col("z")[j]).alias(f"g{j + 1}")
                                       for j in range(len(FEATURES))]
    row = out.agg(*aggs).first()
    return row["g0"], [row[f"g{j + 1}"] for j in range(len(FEATURES))]


def test_l2_first_order_optimality(prepared):
    m = fit_one(prepared, 0.01, 0.0)
    w = m.stages[-1].coefficients.toArray()
    g0, g = residual_gradients(m, prepared)
    assert abs(g0) < 1e-4
    assert max(abs(gj + 0.01 * wj) for gj, wj in zip(g, w)) < 1e-4


def test_l1_subgradient_bound_and_sparsity(prepared):
    m1 = fit_one(prepared, 0.01, 1.0)
    _, g = residual_gradients(m1, prepared)
    assert max(abs(x) for x in g) <= 0.01 + 1e-4
    m2 = fit_one(prepared, 0.01, 0.0)
    nz = lambda m: int((abs(m.stages[-1].coefficients.toArray()) > 0).sum())
    assert nz(m1) <= nz(m2)


def test_folded_linear_scorer_equals_transform(prepared):
    m = fit_one(prepared, 0.1, 0.5)
    a = score(m, prepared).select("id", F.col("prediction").alias("p1"),
                                  vector_to_array("probability")[1].alias("q1"))
    b = with_linear_score(prepared, linear_model(m)).select("id", F.col("prediction").alias("p2"),
                                                             F.col("probability").alias("q2"))
    j = a.join(b, "id")
    assert j.filter("p1 != p2").count() == 0
    assert j.agg(F.max(F.abs(F.col("q1") - F.col("q2")))).first()[0] < 1e-9


def test_cv_holdout_beats_majority(spark):
    df = prepare(train_patients(spark, SF_SMALL)).frame
    tr, te = hash_holdout(df)
    model = fit_cv(tr)
    m = accuracy_metrics(score(model, te)).first()
    majority = max(m.tp + m.fn, m.tn + m.fp) / m.n
    assert m.accuracy >= majority + 0.10
    assert m.tp > 0 and m.tn > 0
    grid = cv_grid_metrics(spark, model).collect()
    assert len(grid) == 6 and {(r.regParam, r.elasticNetParam) for r in grid} == {
        (a, b) for a in (0.1, 0.01) for b in (0.0, 0.5, 1.0)}
    assert len(lr_coefficients(spark, model).collect()) == len(FEATURES) + 1


def test_folds_are_layout_independent(spark):
    df = with_folds(train_patients(spark, SF_SMALL))
    a = {r.id: r.fold for r in df.select("id", "fold").collect()}
    b = {r.id: r.fold for r in df.repartition(5).select("id", "fold").collect()}
    assert a == b and set(a.values()) == {0, 1, 2, 3, 4}


def test_scorer_raises_on_a_missing_feature(spark, prepared):
    m = fit_one(prepared, 0.1, 1.0)   # some weights are 0: a gap there is an error too
    lm = linear_model(m)
    assert 0.0 in lm.weights
    dropped = FEATURES[lm.weights.index(0.0)]
    for column, gap in ((dropped, None), ("sysBP", None), ("BMI", float("nan"))):
        bad = prepared.withColumn(column, F.when(F.col("id") % 50 != 0, F.col(column).cast("double"))
                                  .otherwise(F.lit(gap).cast("double")))
        for want in (["prediction"], ["margin"]):
            with pytest.raises(Exception, match=f"without a value in: {column}"):
                with_linear_score(bad, lm).select(*want).write.format("noop").mode("overwrite").save()
        with pytest.raises(Exception):  # as the fitted pipeline does
            score(m, bad).select("prediction").write.format("noop").mode("overwrite").save()


def test_cv_equals_cross_validator(spark):
    from pyspark.ml.tuning import CrossValidator

    from cohortlab.operators.model import FOLD, accuracy_evaluator, param_grid
    df = prepare(train_patients(spark, SF_SMALL)).frame
    ours = fit_cv(df, max_iter=30)
    pipe, lr = pipeline(max_iter=30)
    theirs = CrossValidator(estimator=pipe, estimatorParamMaps=param_grid(lr), evaluator=accuracy_evaluator(),
                            numFolds=5, foldCol=FOLD).fit(with_folds(df))
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics, abs=1e-9)
    assert ours.stdMetrics == pytest.approx(theirs.stdMetrics, abs=1e-9)
    assert list(linear_model(ours).weights) == pytest.approx(list(linear_model(theirs).weights), rel=1e-6)
    assert [sorted(p.name for p in m) for m in ours.getEstimatorParamMaps()] == [["elasticNetParam", "regParam"]] * 6


def test_one_scaler_fit_per_fold(spark, monkeypatch):
    import cohortlab.operators.model as model
    fits, make = [], model.scaler

    def counted():
        s = make()
        fit = s.fit
        s.fit = lambda df: fits.append(1) or fit(df)
        return s
    monkeypatch.setattr(model, "scaler", counted)
    fit_cv(prepare(train_patients(spark, SF_SMALL)).frame, max_iter=3)
    assert len(fits) == 6


def test_optimality_fails_on_a_wrong_penalty(spark, prepared):
    m = fit_one(prepared, 0.01, 0.0)
    assert all(r.optimal for r in optimality(spark, m, prepared, 0.01, 0.0).collect())
    assert not all(r.optimal for r in optimality(spark, m, prepared, 0.1, 0.0).collect())


def test_negative_and_null_keys(spark):
    ids = [-7, -1, -2_000_000_000, 5, None, 0]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    folds = {r.id: r.fold for r in with_folds(df).collect()}
    assert folds == {i: 0 if i is None else (i * 104729) % 1013 % 5 for i in ids}
    tr, te = hash_holdout(df)
    larger = [i for i in ids if i is None or (i * 49979687) % 1009 < 706]
    assert sorted((r.id for r in tr.collect()), key=str) == sorted(larger, key=str)
    assert tr.count() + te.count() == len(ids)
    negated = prepare(train_patients(spark, SF_SMALL).withColumn("id", -F.col("id"))).frame
    assert len(fit_cv(negated, max_iter=3).avgMetrics) == 6


def test_key_hashes_do_not_overflow_on_int_ids(spark):
    ids = [0, 1, 1008, 2_000_000_000, 2_147_483_647]
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    folds = {r.id: r.fold for r in with_folds(df).collect()}
    assert folds == {i: (i * 104729) % 1013 % 5 for i in ids}
    tr, te = hash_holdout(df)
    assert sorted(r.id for r in tr.collect()) == sorted(i for i in ids if (i * 49979687) % 1009 < 706)
    assert tr.count() + te.count() == len(ids)

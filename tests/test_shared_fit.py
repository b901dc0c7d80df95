import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlab.operators import shared_fit
from cohortlab.operators.model import FOLD, accuracies, fold_models, logistic, param_grid, scaler

GRID = {"reg_params": (0.1, 0.0005), "elastic_net_params": (0.0, 0.5)}


def rows(spark, n=900, noise=1.0, far=0.0, seed=7, one_class_in=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1.0, 30.0, 0.01, 5.0] + [far, 0.0, 3.0, -2.0]
    x[:, 3] = np.round(x[:, 3])
    x = np.column_stack([x, np.full(n, 2.5)])                       # a constant column
    y = (x[:, 0] - far + 0.05 * x[:, 1] + noise * rng.normal(size=n) > 0.3).astype(int)
    fold = np.arange(n) % 3
    if one_class_in is not None:
        y = np.where(fold == one_class_in, y, 0)
    data = [(int(a), Vectors.dense(b.tolist()), int(c)) for a, b, c in zip(y, x, fold)]
    return spark.createDataFrame(data, ["y", "features", FOLD]).repartition(3).cache()


def both(data):
    """The fold models, and MLlib's own fits on the same training parts."""
    lr = logistic("y")
    grid = param_grid(lr, *GRID.values())
    scalers = [scaler().fit(data.where(F.col(FOLD) != k)) for k in range(3)]
    ours = fold_models(data, scaler().fit(data), scalers, lr, grid, "y")
    theirs = [[lr.fit(s.transform(data.where(F.col(FOLD) != k)), p) for p in grid] for k, s in enumerate(scalers)]
    return ours, theirs, scalers


@pytest.mark.parametrize("how", [{"far": 1e4}, {"noise": 1e6}])
def test_shared_fits_end_where_mllib_ends(spark, how):
    data = rows(spark, **how)
    ours, theirs, scalers = both(data)
    for k, (a, b) in enumerate(zip(ours, theirs)):
        for m, want in zip(a, b):
            assert m.coefficients.toArray().tolist() == pytest.approx(want.coefficients.toArray().tolist(), rel=1e-6, abs=1e-9)
            assert m.intercept == pytest.approx(want.intercept, rel=1e-6, abs=1e-9)
            assert (m.getRegParam(), m.getElasticNetParam(), m.getMaxIter()) == (
                want.getRegParam(), want.getElasticNetParam(), want.getMaxIter())
        valid = scalers[k].transform(data.where(F.col(FOLD) == k))
        assert accuracies(valid, a, "y") == accuracies(valid, b, "y")
        got, want = (m.transform(valid).select("prediction").collect() for m in (a[0], b[0]))
        assert got == want                                          # the models are MLlib's, they transform


def test_scans_do_not_grow_with_folds_and_grid_points(spark, monkeypatch):
    """MLlib scans the rows for every step of every fit; here the fits share their scans."""
    scans, scan = [], shared_fit.sums

    def counted(blocked, points):
        scans.append(sum(w.shape[1] for w, _ in points.values()))
        return scan(blocked, points)
    monkeypatch.setattr(shared_fit, "sums", counted)
    ours, _, _ = both(rows(spark))
    fits = sum(len(a) for a in ours)
    assert fits == 12 and scans[0] == fits and len(scans) < 80 and sum(scans) > 5 * len(scans)


def test_a_part_of_one_class_is_fitted_by_mllib(spark):
    ours, theirs, _ = both(rows(spark, one_class_in=1))             # without fold 1 no row is positive
    assert [m.intercept for m in ours[1]] == [m.intercept for m in theirs[1]] == [-math.inf] * 4
    assert ours[0][0].intercept == pytest.approx(theirs[0][0].intercept, rel=1e-6)


def test_blocks_keep_every_row_in_its_fold(spark, monkeypatch):
    monkeypatch.setattr(shared_fit, "BLOCK_ROWS", 100)
    data = rows(spark, n=1000)
    scaled = scaler().fit(data).transform(data)
    got = shared_fit.blocks(scaled, "y", FOLD, 1000).collect()
    found = sorted((b.fold, y, *z) for b in got for y, z in zip(
        np.frombuffer(bytes(b.y)).tolist(), np.frombuffer(bytes(b.z)).reshape(-1, 5).tolist()))
    assert found == sorted((r[FOLD], float(r.y), *r.scaledFeatures.toArray().tolist()) for r in scaled.collect())
    assert max(len(bytes(b.y)) // 8 for b in got) == 100


def test_an_infinite_feature_is_an_error(spark):
    data = rows(spark)
    bad = data.unionByName(spark.createDataFrame([(1, Vectors.dense([math.inf, 0.0, 0.0, 0.0, 2.5]), 0)], data.schema))
    with pytest.raises(Exception, match="NaN or"):
        both(bad)


def test_block_sums_are_the_plain_ones():
    rng = np.random.default_rng(3)
    y, z = (rng.random(1100) < 0.3).astype(float), rng.normal(size=(1100, 3))
    z[:4] = [[900.0, 0, 0], [-900.0, 0, 0], [40.0, 0, 0], [-40.0, 0, 0]]   # margins that exp cannot take as they are
    w, b = rng.normal(size=(3, 5)), rng.normal(size=5)
    w[:, 0], b[0] = 0.0, 0.0                                        # all margins 0: products of 2
    m = z @ w + b
    loss = np.logaddexp(0.0, m) - y[:, None] * m
    r = np.exp(-np.logaddexp(0.0, -m)) - y[:, None]
    assert np.allclose(shared_fit.block_sums(y, z, w, b), np.vstack([loss.sum(axis=0), r.sum(axis=0), z.T @ r]), rtol=1e-11, atol=1e-9)

import math

import duckdb
import pytest

import __spark_entry__ as E
from cohortlab.oracles import oracle_sql
from cohortlab.queries import registry
from conftest import SF_SMALL

FAST = ["encode_categoricals", "missing_count", "column_medians", "prepare_rows", "impute_median",
        "target_by_age", "target_by_sex", "prediction_by_bp_meds", "prediction_counts",
        "chart_series_target", "chart_series_missing", "profile_raw", "profile_raw_text", "head_rows", "hash_split",
        "fold_sizes", "standard_scale", "linear_score", "accuracy_metric", "chart_series_prediction",
        "impute_train_medians_all_columns", "csv_sink_single_file", "schema_rows", "describe_text",
        "random_split_total", "hash_holdout_sizes", "fold_sizes_odd_ids", "lr_optimal_l2", "lr_optimal_l1",
        "lr_optimal_elastic", "holdout_confusion_adds_up", "scored_rows_agree"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry()) == set(oracle_sql())     # this part of the library: no query without a check


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    a = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    idx = {c: i for i, c in enumerate(ocols)}
    b = sorted(tuple(_norm(r[idx[c]]) for c in cols) for r in res.fetchall())
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["age", "prediction_1", "prediction_0", "Total"]
    assert len(rows) > 0 and [r.age for r in rows] == sorted(r.age for r in rows)


def test_the_fits_are_queries_too(spark, monkeypatch):
    q = E.queries()
    assert q["cv_grid_metrics"](spark, SF_SMALL).count() == 6
    assert q["scored_rows"](spark, SF_SMALL).count() == q["scored_rows_linear"](spark, SF_SMALL).count() > 1
    assert q["lr_coefficients"](spark, SF_SMALL).count() > 1 and q["random_split_sizes"](spark, SF_SMALL).count() == 2
    from cohortlab import queries
    asked, whole = [], queries.holdout_metrics
    monkeypatch.setattr(queries, "holdout_metrics", lambda *a, **k: asked.append(k) or whole(*a, **k))
    assert q["holdout_metrics"](spark, SF_SMALL).count() == q["holdout_confusion_adds_up"](spark, SF_SMALL).count() == 1
    assert not any("params" in name for k in asked for name in k)  # the default grid

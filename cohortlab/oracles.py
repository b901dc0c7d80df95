"""DuckDB SQL for each registered query (tables are the driver's views).

Written independently of the Spark code, from the same definitions: the patient
fixture text, ``quantile_disc`` for the lower median, plain GROUP BY / UNION ALL.
"""

from __future__ import annotations

from cohortlab.queries import FIXED_INTERCEPT, FIXED_WEIGHTS, GAPS, KEY_SUFFIX
from cohortlab.schema import EXPLORE_KEYS, EXPORT_COLUMNS, FEATURES, ID, LABEL
from cohortlab.sources.fixtures import PATIENT_EXPRESSIONS, TRAIN_EXPR, patients_sql

COLUMNS = [n for n, _ in PATIENT_EXPRESSIONS]
GRID = "(VALUES (0.1), (0.01)) a(r), (VALUES (0.0), (0.5), (1.0)) b(e)"
DRIFT_TYPES = "id bigint, value double, gap int, sex string"
SCORED_COLUMNS = [c for c in COLUMNS if c != LABEL]
STRING_RAW = {"sex", "is_smoking"}
INT_COLUMNS = {"age", "prevalentStroke", "prevalentHyp", "diabetes", LABEL, "sex", "is_smoking"}


def q(c: str) -> str:
    return f'"{c}"'


def _enc_select(cols: list[str]) -> str:
    out = []
    for c in cols:
        if c == "sex":
            out.append("CASE WHEN sex = 'M' THEN 1 ELSE 0 END AS sex")
        elif c == "is_smoking":
            out.append("CASE WHEN is_smoking = 'YES' THEN 1 ELSE 0 END AS is_smoking")
        else:
            out.append(q(c))
    return ", ".join(out)


def _fill_select(cols: list[str], med: str) -> str:
    out = []
    for c in cols:
        if c in (ID, LABEL):
            out.append(f"e.{q(c)}")
        else:
            out.append(f"coalesce(e.{q(c)}, {med}.{q(c)}) AS {q(c)}")
    return ", ".join(out)


def _med_select(cols: list[str], src: str) -> str:
    return ", ".join(f"quantile_disc({q(c)}, 0.5) AS {q(c)}" for c in cols if c not in (ID, LABEL))


BASE = f"""
patients AS ({patients_sql()}),
train AS (SELECT * FROM patients WHERE {TRAIN_EXPR}),
scored AS (SELECT {", ".join(q(c) for c in SCORED_COLUMNS)} FROM patients WHERE NOT ({TRAIN_EXPR})),
enc_train AS (SELECT {_enc_select(COLUMNS)} FROM train),
enc_scored AS (SELECT {_enc_select(SCORED_COLUMNS)} FROM scored),
med_train AS (SELECT {_med_select(COLUMNS, "enc_train")} FROM enc_train),
med_scored AS (SELECT {_med_select(SCORED_COLUMNS, "enc_scored")} FROM enc_scored),
prep_train AS (SELECT {_fill_select(COLUMNS, "m")} FROM enc_train e CROSS JOIN med_train m),
prep_scored AS (SELECT {_fill_select(SCORED_COLUMNS, "m")} FROM enc_scored e CROSS JOIN med_scored m),
rule_scored AS (SELECT *, CASE WHEN CAST(age AS DOUBLE) + "sysBP" / CAST(2 AS DOUBLE) > CAST(125 AS DOUBLE)
                THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM prep_scored),
rule_train AS (SELECT *, CASE WHEN CAST(age AS DOUBLE) + "sysBP" / CAST(2 AS DOUBLE) > CAST(125 AS DOUBLE)
               THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM prep_train)
"""


def with_base(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body}"


def _missing(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({q(c)}) AS BIGINT) AS n_missing FROM {src}"
        for c in cols)


def _profile(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({q(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, min({x}) AS min, max({x}) AS max FROM {src}")
    return " UNION ALL ".join(parts)


def _spread(c: str) -> str:
    if c in STRING_RAW:
        return "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev"
    return f"round(avg(CAST({q(c)} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({q(c)} AS DOUBLE)), 6) AS stddev"


def _category(k: str, decode_smoking: bool) -> str:
    if k == "sex":
        return "CASE WHEN sex = 1 THEN 'M' ELSE 'F' END"
    if k == "is_smoking" and decode_smoking:
        return "CASE WHEN is_smoking = 1 THEN 'YES' ELSE 'NO' END"
    return f"CAST({q(k)} AS VARCHAR)"


def _target(k: str) -> str:
    extra = ", CASE WHEN sex = 1 THEN 'M' ELSE 'F' END AS \"GenderLabel\"" if k == "sex" else ""
    return with_base(
        f"SELECT {q(k)}, CAST(sum(CASE WHEN \"TenYearCHD\" = 1 THEN 1 ELSE 0 END) AS BIGINT) AS \"TenYearCHD\", "
        f"count({q(k)}) AS \"Total\"{extra} FROM prep_train GROUP BY {q(k)}")


def _prediction(k: str) -> str:
    return with_base(
        f"SELECT {q(k)}, CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS prediction_1, "
        f"CAST(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS prediction_0, "
        f"count({q(k)}) AS \"Total\" FROM rule_scored GROUP BY {q(k)}")


def _chart(src: str, label: str, series: tuple[str, str]) -> str:
    parts = []
    for k in EXPLORE_KEYS:
        cat = _category(k, decode_smoking=label == "TenYearCHD")
        if label == "TenYearCHD":
            pos = "CAST(sum(CASE WHEN \"TenYearCHD\" = 1 THEN 1 ELSE 0 END) AS BIGINT)"
            neg = f"CAST(count({q(k)}) - sum(CASE WHEN \"TenYearCHD\" = 1 THEN 1 ELSE 0 END) AS BIGINT)"
        else:
            pos = "CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT)"
            neg = "CAST(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) AS BIGINT)"
        for name, val in ((series[0], pos), (series[1], neg)):
            parts.append(f"SELECT '{k}' AS chart, {cat} AS category, '{name}' AS series, {val} AS n "
                         f"FROM {src} GROUP BY {q(k)}")
    return with_base(" UNION ALL ".join(parts))


ODD_ID = "CASE WHEN id % 10 <> 3 THEN CASE WHEN id % 2 = 0 THEN id ELSE -id END END"


def _pmod(x: str, m: int) -> str:
    return f"((({x}) % {m} + {m}) % {m})"


def _hash(x: str, mult: int, m: int) -> str:
    return _pmod(f"{_pmod(x, m)} * {mult}", m)


def _gappy(c: str, src: str) -> str:
    return f"CASE WHEN id % {GAPS[c]} <> 0 THEN {src}.{q(c)} END" if c in GAPS else f"{src}.{q(c)}"


_TYPES = {"sex": "int", "is_smoking": "int", ID: "bigint"}


def _type(c: str) -> str:
    return _TYPES.get(c, "int" if c in INT_COLUMNS else "double")


def _raw_cast(c: str) -> str:
    return f"CAST({q(c)} AS INTEGER) AS {q(c)}" if c == ID else q(c)


def _export_types() -> str:
    """The export's columns as inference reads them back: an int prints as int, a double with a point."""
    return ", ".join(f"{c} {'int' if c == ID else 'double' if c == 'prediction' else _type(c)}" for c in EXPORT_COLUMNS)


def oracle_sql() -> dict[str, str]:
    numeric_raw = [c for c in COLUMNS if c not in STRING_RAW]
    feats = ", ".join(q(f) for f in FEATURES)
    o: dict[str, str] = {
        "csv_scan": with_base(f"SELECT {', '.join(_raw_cast(c) for c in COLUMNS)} FROM train"),
        "csv_sink_roundtrip": with_base(f"SELECT {', '.join(q(c) for c in EXPORT_COLUMNS)} FROM rule_scored"),
        "encode_categoricals": with_base("SELECT * FROM enc_train"),
        "missing_count": with_base(_missing("enc_train", COLUMNS)),
        "missing_count_after": with_base(_missing("prep_train", COLUMNS)),
        "column_medians": with_base(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(quantile_disc({q(c)}, 0.5) AS DOUBLE) AS median FROM enc_train"
            for c in COLUMNS)),
        "impute_median": with_base(f"SELECT {_fill_select(SCORED_COLUMNS, 'm')} "
                                   "FROM enc_scored e CROSS JOIN med_train m"),
        "impute_train_medians_all_columns": with_base(
            "SELECT " + ", ".join(f"e.{q(c)}" if c == ID else f"coalesce({_gappy(c, 'e')}, m.{q(c)}) AS {q(c)}"
                                  for c in SCORED_COLUMNS) + " FROM enc_scored e CROSS JOIN med_train m"),
        "csv_sink_single_file": with_base(
            "SELECT CAST(1 AS BIGINT) AS files, count(*) AS n_rows, CAST(sum(prediction) AS BIGINT) AS n_positive, "
            "CAST(sum(id) AS BIGINT) AS id_sum FROM rule_scored"),
        "schema_rows": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{_type(c)}' AS type" for c in COLUMNS),
        "describe_text": with_base(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count({q(c)}) AS VARCHAR) AS count, {_spread(c)}, "
            f"CAST(min({q(c)}) AS VARCHAR) AS min, CAST(max({q(c)}) AS VARCHAR) AS max FROM train" for c in COLUMNS)),
        "prepare_rows": with_base("SELECT * FROM prep_train"),
        "profile_raw": with_base(_profile("train", numeric_raw)),
        "profile_raw_text": with_base(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({q(c)}) AS count, min({q(c)}) AS min, max({q(c)}) AS max FROM train"
            for c in COLUMNS if c in STRING_RAW)),
        "profile_prepared": with_base(_profile("prep_train", COLUMNS)),
        "head_rows": with_base("SELECT * FROM prep_train ORDER BY id LIMIT 30"),
    }
    for s, k in KEY_SUFFIX.items():
        o[f"target_by_{s}"] = _target(k)
    for s, k in KEY_SUFFIX.items():
        o[f"prediction_by_{s}"] = _prediction(k)
    margin = f"CAST({FIXED_INTERCEPT!r} AS DOUBLE)"
    for f in FEATURES:
        if f in FIXED_WEIGHTS:
            margin = f"({margin} + CAST({FIXED_WEIGHTS[f]!r} AS DOUBLE) * CAST({q(f)} AS DOUBLE))"
    stats = ", ".join(f"avg(CAST({q(f)} AS DOUBLE)) AS {q('m_' + f)}, stddev_samp(CAST({q(f)} AS DOUBLE)) AS {q('s_' + f)}"
                      for f in FEATURES)
    scaled = " UNION ALL ".join(
        f"SELECT p.id, '{f}' AS feature, round(CASE WHEN s.{q('s_' + f)} = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE (CAST(p.{q(f)} AS DOUBLE) - s.{q('m_' + f)}) / s.{q('s_' + f)} END, 6) AS value "
        f"FROM prep_train p CROSS JOIN st s" for f in FEATURES)
    o.update({
        "prediction_counts": with_base(
            "SELECT prediction, count(*) AS prediction_count FROM rule_scored GROUP BY prediction"),
        "export_projection": with_base(f"SELECT {', '.join(q(c) for c in EXPORT_COLUMNS)} FROM rule_scored"),
        "chart_series_missing": with_base(
            " UNION ALL ".join(
                f"SELECT 'missing' AS chart, '{c}' AS category, '{series}' AS series, "
                f"CAST(count(*) - count({q(c)}) AS BIGINT) AS n FROM {src}"
                for src, series in (("enc_train", "Missing Data"), ("prep_train", "Missing Data (After)"))
                for c in COLUMNS)),
        "chart_series_target": _chart("prep_train", "TenYearCHD", ("TenYearCHD", "Non TenYearCHD")),
        "chart_series_prediction": _chart("rule_scored", "prediction", ("Prediction_1", "Prediction_0")),
        "hash_split": with_base(
            f"SELECT CASE WHEN {TRAIN_EXPR} THEN 'train' ELSE 'score' END AS split, count(*) AS n "
            "FROM patients GROUP BY 1"),
        "fold_sizes": with_base(
            "SELECT CAST(((id % 1013) * 104729) % 1013 % 5 AS INTEGER) AS fold, count(*) AS n "
            "FROM train GROUP BY 1"),
        "fold_sizes_odd_ids": with_base(
            f"SELECT CAST(coalesce({_hash(ODD_ID, 104729, 1013)} % 5, 0) AS INTEGER) AS fold, count(*) AS n "
            "FROM train GROUP BY 1"),
        "hash_holdout_sizes": with_base(
            f"SELECT CASE WHEN coalesce({_hash(ODD_ID, 49979687, 1009)} < 706, true) THEN 'train' ELSE 'holdout' END "
            "AS split, count(*) AS n FROM train GROUP BY 1"),
        "random_split_total": with_base(
            "SELECT count(*) AS n, count(DISTINCT id) AS n_ids, true AS train_share_near_0_7 FROM train"),
        **{f"lr_optimal_{name}": " UNION ALL ".join(f"SELECT '{f}' AS term, true AS optimal"
                                                    for f in (*FEATURES, "intercept")) for name in ("l2", "l1", "elastic")},
        "cv_grid_accuracy_in_range": "SELECT CAST(r AS DOUBLE) AS \"regParam\", CAST(e AS DOUBLE) AS \"elasticNetParam\", "
                                     f"true AS in_range FROM {GRID}",
        "holdout_confusion_adds_up": with_base(
            f"SELECT count(*) AS n, count(*) FILTER (WHERE \"TenYearCHD\" = 1) AS positives, "
            f"count(*) FILTER (WHERE \"TenYearCHD\" = 0) AS negatives, true AS accuracy_fits, true AS beats_majority FROM train "
            f"WHERE NOT ({_hash('id', 49979687, 1009)} < 706)"),
        "cv_fold_accuracy": with_base(
            "SELECT f.fold, CAST(r AS DOUBLE) AS \"regParam\", CAST(e AS DOUBLE) AS \"elasticNetParam\", f.n, true AS recounted "
            "FROM (SELECT CAST(((id % 1013) * 104729) % 1013 % 5 AS INTEGER) AS fold, count(*) AS n FROM train GROUP BY 1) f, "
            + GRID),
        "lr_refit_optimal": " UNION ALL ".join(f"SELECT '{f}' AS term, true AS optimal" for f in (*FEATURES, "intercept")),
        "exact_split": with_base(
            "SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('520:' || CAST(id AS VARCHAR))) <= (7 * count(*) OVER ()) // 10 "
            "THEN 'train' ELSE 'holdout' END AS split FROM train"),
        "csv_joint_schema": with_base(
            f"SELECT id, CAST(CAST(\"totChol\" AS INTEGER) AS DOUBLE) AS value, CAST(NULL AS INTEGER) AS gap, sex, 'train' AS file, "
            f"'{DRIFT_TYPES}' AS types FROM train UNION ALL "
            f"SELECT id + 5000000000, \"totChol\" + 0.25, CAST(\"sysBP\" AS INTEGER), CAST(age AS VARCHAR), 'scored', '{DRIFT_TYPES}' FROM scored"),
        "job_export": with_base(
            f"SELECT count(*) AS n_rows, '{_export_types()}' AS types, count(*) AS histogram_total, "
            "CAST(29 AS INTEGER) AS report_tables, CAST(" + " + ".join(f"count(*) - count({q(c)})" for c in SCORED_COLUMNS)
            + " AS BIGINT) AS n_missing_before FROM enc_scored"),
        "scored_rows_agree": with_base(
            "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_disagree, true AS both_classes FROM scored"),
        "feature_array": with_base(" UNION ALL ".join(
            f"SELECT id, '{f}' AS feature, CAST({q(f)} AS DOUBLE) AS value FROM prep_train" for f in FEATURES)),
        "standard_scale": with_base(f"SELECT * FROM (WITH st AS (SELECT {stats} FROM prep_train) {scaled})"),
        "linear_score": with_base(
            f"SELECT id, round({margin}, 6) AS margin, round(1 / (1 + exp(-({margin}))), 6) AS probability, "
            f"CASE WHEN {margin} > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction "
            "FROM prep_scored"),
        "accuracy_metric": with_base(
            "SELECT count(*) AS n, round(avg(CASE WHEN CAST(\"TenYearCHD\" AS DOUBLE) = prediction "
            "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS accuracy, "
            "count(*) FILTER (WHERE \"TenYearCHD\" = 1 AND prediction = 1) AS tp, "
            "count(*) FILTER (WHERE \"TenYearCHD\" = 0 AND prediction = 0) AS tn, "
            "count(*) FILTER (WHERE \"TenYearCHD\" = 0 AND prediction = 1) AS fp, "
            "count(*) FILTER (WHERE \"TenYearCHD\" = 1 AND prediction = 0) AS fn FROM rule_train"),
    })
    return o

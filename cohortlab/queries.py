"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver's ``events`` table through the patient fixture, so
their work grows with the table. ``oracles.py`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.operators.encode import encode_categoricals
from cohortlab.operators.explore import (chart_series_missing, chart_series_prediction,
                                         chart_series_target, prediction_by, prediction_counts,
                                         target_by)
from cohortlab.operators.features import feature_long, standard_scale_long
from cohortlab.operators.impute import apply_medians, fit_medians
from cohortlab.operators.median import exact_medians
from cohortlab.operators.missing import missing_counts
from cohortlab.operators.model import (LinearModel, accuracy_metrics, best_params, cv_fold_metrics, cv_grid_metrics,
                                       exact_holdout, fit_cv, fold_column, hash_holdout, holdout_metrics, linear_model, lr_coefficients,
                                       optimality, pipeline, random_holdout, score, with_folds, with_linear_score)
from cohortlab.operators.profile import describe, head_rows, profile, profile_text, schema_rows
from cohortlab.plans.job import run_job
from cohortlab.plans.prepare import prepare
from cohortlab.schema import EXPLORE_KEYS, EXPORT_COLUMNS, FEATURES, ID, PREDICTION
from cohortlab.session import scratch_path
from cohortlab.sources.files import load_train_test, read_patients
from cohortlab.sources.fixtures import patients, scored_patients, train_flag, train_patients
from cohortlab.sources.sink import export_projection, write_predictions

# Query key suffix -> patient column.
KEY_SUFFIX = dict(zip(("age", "sex", "is_smoking", "heart_rate", "cigs_per_day", "bp_meds"), EXPLORE_KEYS))

# Fixed linear scorer used by ``linear_score`` (a parameter of that query).
FIXED_WEIGHTS = {"age": 0.1, "sysBP": 0.04, "diaBP": 0.03}
FIXED_INTERCEPT = -13.1

# Column complete in the training file -> modulus of the ids whose value is
# taken out of the scored file (``impute_train_medians_all_columns``).
GAPS = {"sysBP": 3, "diaBP": 5, "prevalentHyp": 7}


def rule_prediction(df: DataFrame) -> DataFrame:
    """A fit-free predictor so prediction operators have an exact oracle:
    1 if ``age + sysBP / 2 > 125`` else 0, as double like a model's prediction."""
    cond: Column = F.col("age").cast("double") + F.col("sysBP") / F.lit(2.0) > F.lit(125.0)
    return df.withColumn(PREDICTION, F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def prepared_train(spark: SparkSession, d: str) -> DataFrame:
    return prepare(train_patients(spark, d)).frame


def prepared_scored(spark: SparkSession, d: str) -> DataFrame:
    return prepare(scored_patients(spark, d)).frame


def _rule_scored(spark: SparkSession, d: str) -> DataFrame:
    return rule_prediction(prepared_scored(spark, d))


# ----------------------------------------------------------------- sources ---
def q_csv_scan(spark, d):
    path = scratch_path(spark, "patients-csv")
    train_patients(spark, d).write.option("header", True).csv(path)
    return read_patients(spark, path)                      # header + inferred schema


def q_csv_sink_roundtrip(spark, d):
    path = scratch_path(spark, "predictions-csv")
    scored = _rule_scored(spark, d)
    write_predictions(scored, path)
    return read_patients(spark, path, schema=scored.select(*EXPORT_COLUMNS).schema)


def q_csv_sink_single_file(spark, d):
    """The export as one file: rows per file name that was read back, and columns."""
    path = scratch_path(spark, "predictions-one")
    scored = _rule_scored(spark, d)
    write_predictions(scored.repartition(4), path, single_file=True)
    back = read_patients(spark, path, schema=scored.select(*EXPORT_COLUMNS).schema)
    return back.withColumn("file", F.input_file_name()).groupBy().agg(
        F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(PREDICTION).cast("long")).alias("n_positive"), F.sum(F.col(ID).cast("long")).alias("id_sum"))


def q_csv_joint_schema(spark, d):
    """Two files whose inferred types differ (int and bigint ids, int and double values, a column that
    is empty in one), read with one type per column: every row of both, and the types."""
    paths = [scratch_path(spark, f"drift-{k}") for k in ("train", "scored")]
    whole, other = train_patients(spark, d), scored_patients(spark, d)
    whole.select(ID, F.col("totChol").cast("int").alias("value"), F.lit(None).cast("string").alias("gap"),
                 "sex").write.option("header", True).csv(paths[0])
    other.select((F.col(ID).cast("long") + F.lit(5_000_000_000)).alias(ID), (F.col("totChol") + 0.25).alias("value"),
                 F.col("sysBP").cast("int").alias("gap"), F.col("age").alias("sex")).write.option("header", True).csv(paths[1])
    frames = load_train_test(spark, *paths, joint=True)
    types = [", ".join(f"{n} {t}" for n, t in df.dtypes) for df in frames]
    tagged = [df.withColumns({"file": F.lit(name), "types": F.lit(t)})
              for df, name, t in zip(frames, ("train", "scored"), types)]
    return tagged[0].unionByName(tagged[1])


def q_job_export(spark, d):
    """The whole job on written files: rows of the export, its columns and types as read back,
    rows in the prediction histogram, tables of the report, and the missing counts that were
    gathered while the scored rows were written."""
    paths = [scratch_path(spark, f"job-{k}") for k in ("train", "scored", "out")]
    train_patients(spark, d).write.option("header", True).csv(paths[0])
    scored_patients(spark, d).write.option("header", True).csv(paths[1])
    job = run_job(spark, *paths)
    try:
        back = read_patients(spark, paths[2])
        types = ", ".join(f"{n} {t}" for n, t in back.dtypes)
        missing = job.test.missing().agg(F.sum("n_missing")).first()[0]
        total = job.prediction_counts().agg(F.sum("prediction_count")).first()[0]
        return back.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(types).alias("types"), F.lit(total).cast("long").alias("histogram_total"),
                        F.lit(len(job.report_tables)).alias("report_tables"), F.lit(missing).cast("long").alias("n_missing_before"))
    finally:
        job.release()


# ---------------------------------------------------------------- prepare ---
def q_encode_categoricals(spark, d):
    return encode_categoricals(train_patients(spark, d))


def q_missing_count(spark, d):
    return missing_counts(encode_categoricals(train_patients(spark, d)))


def q_missing_count_after(spark, d):
    return missing_counts(prepared_train(spark, d))


def q_column_medians(spark, d):
    enc = encode_categoricals(train_patients(spark, d))
    med = exact_medians(enc, enc.columns)
    return spark.createDataFrame([(c, med[c]) for c in enc.columns], "column string, median double")


def q_impute_median(spark, d):
    """The scored file filled with the training file's medians."""
    med = fit_medians(encode_categoricals(train_patients(spark, d)), only_needed=True)
    return apply_medians(encode_categoricals(scored_patients(spark, d)), med)


def gappy_scored(spark, d) -> DataFrame:
    """The scored file with gaps in columns that are complete in the training file."""
    df = scored_patients(spark, d)
    for c, m in GAPS.items():
        df = df.withColumn(c, F.when(F.col(ID) % m != 0, F.col(c)))
    return df


def q_impute_train_medians_all_columns(spark, d):
    """Gaps anywhere in the scored file filled with the training file's medians."""
    med = prepare(train_patients(spark, d)).medians_for_other()
    return prepare(gappy_scored(spark, d), medians=med).frame


def q_schema_rows(spark, d):
    """The printed schema of the encoded training file as rows."""
    return schema_rows(spark, encode_categoricals(train_patients(spark, d))).select("column", "type")


def q_describe_text(spark, d):
    """count, min and max of every raw column, as ``describe`` prints them, by column; mean and
    stddev read back from their text and rounded."""
    raw = train_patients(spark, d)
    wide = describe(raw, raw.columns)
    long = wide.unpivot(["summary"], raw.columns, "column", "value")
    by = long.groupBy("column").pivot("summary", ["count", "mean", "stddev", "min", "max"]).agg(F.first("value"))
    return by.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("mean", "stddev")})


def q_prepare_rows(spark, d):
    return prepared_train(spark, d)


def q_profile_raw(spark, d):
    return profile(train_patients(spark, d))


def q_profile_raw_text(spark, d):
    return profile_text(train_patients(spark, d))


def q_profile_prepared(spark, d):
    return profile(prepared_train(spark, d))


def q_head_rows(spark, d):
    return head_rows(prepared_train(spark, d), 30, ID)


# ---------------------------------------------------------------- explore ---
def _target(suffix):
    return lambda spark, d: target_by(prepared_train(spark, d), KEY_SUFFIX[suffix])


def _prediction(suffix):
    return lambda spark, d: prediction_by(_rule_scored(spark, d), KEY_SUFFIX[suffix])


def q_prediction_counts(spark, d):
    return prediction_counts(_rule_scored(spark, d))


def q_export_projection(spark, d):
    return export_projection(_rule_scored(spark, d))


def q_chart_series_missing(spark, d):
    enc = encode_categoricals(train_patients(spark, d))
    return chart_series_missing(missing_counts(enc), missing_counts(prepared_train(spark, d)))


def q_chart_series_target(spark, d):
    return chart_series_target(prepared_train(spark, d), EXPLORE_KEYS)


def q_chart_series_prediction(spark, d):
    return chart_series_prediction(_rule_scored(spark, d), EXPLORE_KEYS)


# ------------------------------------------------------------ model parts ---
def q_hash_split(spark, d):
    split = F.when(train_flag(), F.lit("train")).otherwise(F.lit("score")).alias("split")
    return patients(spark, d).groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def q_fold_sizes(spark, d):
    return (train_patients(spark, d).groupBy(fold_column().alias("fold"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_feature_array(spark, d):
    return feature_long(prepared_train(spark, d))


def q_standard_scale(spark, d):
    return standard_scale_long(prepared_train(spark, d))


def q_linear_score(spark, d):
    lm = LinearModel(FEATURES, tuple(FIXED_WEIGHTS.get(f, 0.0) for f in FEATURES), FIXED_INTERCEPT)
    return (with_linear_score(prepared_scored(spark, d), lm)
            .select(ID, F.round("margin", 6).alias("margin"),
                    F.round("probability", 6).alias("probability"), PREDICTION))


def q_accuracy_metric(spark, d):
    m = accuracy_metrics(rule_prediction(prepared_train(spark, d)))
    return m.withColumn("accuracy", F.round("accuracy", 6))


# ------------------------------------- model: checks whose outcome SQL can state ---
def q_random_split_total(spark, d):
    """The 70/30 random split loses and repeats no row: total, distinct ids, both parts in use."""
    train, test = random_holdout(prepared_train(spark, d))
    parts = (train.select(F.lit(1).alias("part"), ID).unionByName(test.select(F.lit(0).alias("part"), ID)))
    return parts.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(ID).alias("n_ids"),
                     F.avg("part").between(0.6, 0.8).alias("train_share_near_0_7"))


def q_hash_holdout_sizes(spark, d):
    """Both parts of the hash split on ids that include negative and null ones."""
    ids = train_patients(spark, d).select(odd_ids().alias(ID))
    parts = hash_holdout(ids)
    return _union_sizes(parts, ("train", "holdout"))


def q_fold_sizes_odd_ids(spark, d):
    """Fold sizes on ids that include negative and null ones."""
    return (train_patients(spark, d).groupBy(fold_column(odd_ids()).alias("fold"))
            .agg(F.count(F.lit(1)).alias("n")))


def odd_ids() -> Column:
    return F.when(F.col(ID) % 10 != 3, F.when(F.col(ID) % 2 == 0, F.col(ID)).otherwise(-F.col(ID)))


def _union_sizes(parts, names) -> DataFrame:
    tagged = [p.select(F.lit(n).alias("split")) for p, n in zip(parts, names)]
    return tagged[0].unionByName(tagged[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def _optimality(reg: float, enet: float):
    def q(spark, d):
        frame = prepared_train(spark, d)
        pipe, lr = pipeline()
        model = pipe.fit(frame, {lr.regParam: reg, lr.elasticNetParam: enet})
        return optimality(spark, model, frame, reg, enet).select("term", "optimal")
    return q


def q_cv_grid_accuracy_in_range(spark, d):
    """The six grid points, each with a mean accuracy in [0, 1] over the folds."""
    grid = cv_grid_metrics(spark, fit_cv(prepared_train(spark, d)))
    return grid.select("regParam", "elasticNetParam", F.col("mean_accuracy").between(0, 1).alias("in_range"))


def q_cv_fold_accuracy(spark, d):
    """Per fold and grid point the fold's rows, and whether the accuracy, which one aggregate counts for
    all of a fold's models on scaled vectors, equals a recount with that model's weights on the raw columns."""
    frame = prepared_train(spark, d)
    model = fit_cv(frame, sub_models=True)
    rows, again = with_folds(frame), []
    for k, fitted in enumerate(model.subModels):
        hits = [F.avg((F.when(linear_model(m).margin() > 0, 1).otherwise(0) == F.col("TenYearCHD")).cast("double"))
                .alias(f"a{i}") for i, m in enumerate(fitted)]
        again += [(k, i, v) for i, v in enumerate(rows.where(F.col("fold") == k).agg(*hits).first())]
    recount = spark.createDataFrame(
        [(k, *best, v) for (k, i, v) in again for best in [_grid_point(model, i)]],
        "fold int, regParam double, elasticNetParam double, recount double")
    return (cv_fold_metrics(spark, model).join(recount, ["fold", "regParam", "elasticNetParam"])
            .select("fold", "regParam", "elasticNetParam", "n", (F.abs(F.col("accuracy") - F.col("recount")) < 1e-12).alias("recounted")))


def _grid_point(model, i: int) -> tuple[float, float]:
    named = {p.name: v for p, v in model.getEstimatorParamMaps()[i].items()}
    return float(named["regParam"]), float(named["elasticNetParam"])


def q_lr_refit_optimal(spark, d):
    """The model that cross-validation refits on all rows is optimal for the parameters it chose."""
    frame = prepared_train(spark, d)
    model = fit_cv(frame)
    return optimality(spark, model.bestModel, frame, *best_params(model)).select("term", "optimal")


def q_exact_split(spark, d):
    """Every row's part in the reproducible 70/30 split, on a layout of its own."""
    parts = exact_holdout(train_patients(spark, d).repartition(7))
    return parts[0].select(ID, F.lit("train").alias("split")).unionByName(parts[1].select(ID, F.lit("holdout").alias("split")))


def q_holdout_confusion_adds_up(spark, d):
    """Hold-out metrics on the hash split: the part's size, positives and negatives
    (so every row was scored once), accuracy = (tp + tn) / n, and that it beats the
    larger class by a tenth."""
    m, _ = holdout_metrics(prepared_train(spark, d), split="hash")
    return m.select("n", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("tn") + F.col("fp")).alias("negatives"),
                    (F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / F.col("n")) < 1e-12).alias("accuracy_fits"),
                    (F.col("accuracy") >= F.greatest(F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")) / F.col("n") + 0.1)
                    .alias("beats_majority"))


def q_scored_rows_agree(spark, d):
    """The scored file through the fitted pipeline and through the folded linear
    scorer: rows, rows where class or probability disagree, rows of either class alone."""
    train, scored = prepared_train(spark, d), prepared_scored(spark, d)
    pipe, lr = pipeline()
    model = pipe.fit(train, {lr.regParam: 0.01})
    both = with_linear_score(score(model, scored).select(
        *FEATURES, F.col(PREDICTION).alias("p"), vector_to_array("probability")[1].alias("q")), linear_model(model))
    differ = (F.col("p") != F.col(PREDICTION)) | ~(F.abs(F.col("q") - F.col("probability")) < 1e-9)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(differ).alias("n_disagree"),
                    (F.countDistinct(PREDICTION) == 2).alias("both_classes"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "csv_scan": q_csv_scan,
        "csv_sink_roundtrip": q_csv_sink_roundtrip,
        "csv_sink_single_file": q_csv_sink_single_file,
        "csv_joint_schema": q_csv_joint_schema,
        "encode_categoricals": q_encode_categoricals,
        "missing_count": q_missing_count,
        "missing_count_after": q_missing_count_after,
        "column_medians": q_column_medians,
        "impute_median": q_impute_median,
        "impute_train_medians_all_columns": q_impute_train_medians_all_columns,
        "prepare_rows": q_prepare_rows,
        "schema_rows": q_schema_rows,
        "describe_text": q_describe_text,
        "profile_raw": q_profile_raw,
        "profile_raw_text": q_profile_raw_text,
        "profile_prepared": q_profile_prepared,
        "head_rows": q_head_rows,
    }
    for s in KEY_SUFFIX:
        q[f"target_by_{s}"] = _target(s)
    for s in KEY_SUFFIX:
        q[f"prediction_by_{s}"] = _prediction(s)
    q.update({
        "prediction_counts": q_prediction_counts,
        "export_projection": q_export_projection,
        "chart_series_missing": q_chart_series_missing,
        "chart_series_target": q_chart_series_target,
        "chart_series_prediction": q_chart_series_prediction,
        "hash_split": q_hash_split,
        "fold_sizes": q_fold_sizes,
        "feature_array": q_feature_array,
        "standard_scale": q_standard_scale,
        "linear_score": q_linear_score,
        "accuracy_metric": q_accuracy_metric,
        "random_split_total": q_random_split_total,
        "hash_holdout_sizes": q_hash_holdout_sizes,
        "fold_sizes_odd_ids": q_fold_sizes_odd_ids,
        "lr_optimal_l2": _optimality(0.01, 0.0),
        "lr_optimal_l1": _optimality(0.01, 1.0),
        "lr_optimal_elastic": _optimality(0.1, 0.5),
        "cv_grid_accuracy_in_range": q_cv_grid_accuracy_in_range,
        "cv_fold_accuracy": q_cv_fold_accuracy,
        "lr_refit_optimal": q_lr_refit_optimal,
        "exact_split": q_exact_split,
        "holdout_confusion_adds_up": q_holdout_confusion_adds_up,
        "job_export": q_job_export,
        "scored_rows_agree": q_scored_rows_agree,
    })
    return q


# ---------------------------------------------- fits as such, beside their checks ---
def q_random_split_sizes(spark, d):
    return _union_sizes(random_holdout(prepared_train(spark, d)), ("train", "holdout"))


def q_lr_coefficients(spark, d):
    return lr_coefficients(spark, fit_cv(prepared_train(spark, d)))


def q_cv_grid_metrics(spark, d):
    return cv_grid_metrics(spark, fit_cv(prepared_train(spark, d)))


def q_holdout_metrics(spark, d):
    return holdout_metrics(prepared_train(spark, d))[0]


def q_scored_rows(spark, d):
    """Scored file through the fitted pipeline (MLlib transform), export columns."""
    return export_projection(score(fit_cv(prepared_train(spark, d)), prepared_scored(spark, d)))


def q_scored_rows_linear(spark, d):
    """Same rows through the folded linear scorer."""
    model = linear_model(fit_cv(prepared_train(spark, d)))
    return export_projection(with_linear_score(prepared_scored(spark, d), model))


def unchecked() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Whole queries whose rows no SQL can state."""
    return {f.__name__[2:]: f for f in (q_random_split_sizes, q_lr_coefficients, q_cv_grid_metrics, q_holdout_metrics,
                                        q_scored_rows, q_scored_rows_linear)}

"""Standardised logistic regression with a cross-validated grid, scoring and metrics.

MLlib fits the scalers and the model that is kept. What is added here is the wiring
and three scale points: the training rows are assembled and persisted once for
all 31 fits, and the 30 fits of the cross-validation share their scans (``shared_fit``); folds come from a key hash (so they are the
same on any cluster layout and re-running a lost task gives the same rows);
and fitted models can be applied as one linear column expression that stays
inside whole-stage codegen (no vector columns in the scoring path).
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.functions.keys import hash_mod
from cohortlab.operators.shared_fit import Part, blocks, fit_all
from cohortlab.schema import FEATURES, ID, LABEL, PREDICTION

# ---------------------------------------------------------------------------
# Fixed values that must equal the original application's: optimiser
# iteration cap, the grid, the fold count, hold-out split weights and seed.
MAX_ITER = 10000
REG_PARAMS = (0.1, 0.01)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)
NUM_FOLDS = 5
HOLDOUT_WEIGHTS = (0.7, 0.3)
HOLDOUT_SEED = 520
# ---------------------------------------------------------------------------

FOLD = "fold"


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    """15 columns in order -> ``features``; a null input is an error (handleInvalid=error)."""
    return VectorAssembler(inputCols=list(features), outputCol="features")


def scaler() -> StandardScaler:
    """(x - mean) / sample stddev -> ``scaledFeatures``; a constant column scales to 0."""
    return StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=True)


def logistic(label: str = LABEL, max_iter: int = MAX_ITER) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="scaledFeatures", maxIter=max_iter)


def pipeline(features: Sequence[str] = FEATURES, label: str = LABEL,
             max_iter: int = MAX_ITER) -> tuple[Pipeline, LogisticRegression]:
    lr = logistic(label, max_iter)
    return Pipeline(stages=[assembler(features), scaler(), lr]), lr


def param_grid(lr: LogisticRegression, reg_params: Sequence[float] = REG_PARAMS,
               elastic_net_params: Sequence[float] = ELASTIC_NET_PARAMS):
    return (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_net_params)).build())


def accuracy_evaluator(label: str = LABEL) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=PREDICTION,
                                             metricName="accuracy")


def fold_column(id_col: Column | str = ID, num_folds: int = NUM_FOLDS) -> Column:
    """Fold of a row from its key: ``((id * 104729) mod 1013) mod num_folds``, 0 for a null key."""
    return F.coalesce(hash_mod(id_col, 104729, 1013) % F.lit(num_folds), F.lit(0)).cast("int")


def with_folds(df: DataFrame, id_col: str = ID, num_folds: int = NUM_FOLDS) -> DataFrame:
    return df.withColumn(FOLD, fold_column(id_col, num_folds))


def fit_cv(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL,
           num_folds: int = NUM_FOLDS, parallelism: int = 6, max_iter: int = MAX_ITER,
           reg_params: Sequence[float] = REG_PARAMS,
           elastic_net_params: Sequence[float] = ELASTIC_NET_PARAMS,
           id_col: str = ID, sub_models: bool = False) -> CrossValidatorModel:
    """5-fold CV over the 6-point grid, best mean accuracy, refit on all rows.

    The rows are assembled to (label, features, fold) and persisted (memory,
    spilling to disk) once; there are ``num_folds + 1`` scaler fits. All fits of all folds
    advance together (``fold_models``): one scan of one blocked copy of the rows per optimiser step,
    whatever the number of folds and grid points. The refit is MLlib's own.
    ``parallelism`` fits run at once where MLlib must fit a fold (``fold_models``).
    A fold's fitted models are measured together, in one aggregate over its rows.

    The model has ``foldMetrics``: (rows of the fold, accuracy per grid point) by fold;
    with ``sub_models`` also every fold's fitted pipelines, as ``subModels``.
    """
    pipe, lr = pipeline(features, label, max_iter)
    grid = param_grid(lr, reg_params, elastic_net_params)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=accuracy_evaluator(label),
                        numFolds=num_folds, foldCol=FOLD, parallelism=parallelism)
    level = StorageLevel.MEMORY_AND_DISK
    rows = with_folds(df.select(id_col, *features, label), id_col, num_folds)
    data = assembler(features).transform(rows).select(label, "features", FOLD).persist(level)
    metrics, fitted = [], []
    try:
        whole = scaler().fit(data)
        scalers = [scaler().fit(data.where(F.col(FOLD) != k)) for k in range(num_folds)]
        by_fold = fold_models(data, whole, scalers, lr, grid, label, parallelism)
        for k, (scaled, models) in enumerate(zip(scalers, by_fold)):
            metrics.append(accuracies(scaled.transform(data.where(F.col(FOLD) == k)), models, label))
            if not metrics[-1][0]:
                raise ValueError(f"fold {k} has no rows to measure on")
            if sub_models:
                fitted.append([PipelineModel([assembler(features), scaled, m]) for m in models])
        folds = [m for _, m in metrics]
        mean, std = np.mean(folds, axis=0), np.std(folds, axis=0)
        best = lr.fit(whole.transform(data), grid[int(np.argmax(mean))])
    finally:
        data.unpersist()
    model = PipelineModel([assembler(features), whole, best])
    out = cv._copyValues(CrossValidatorModel(model, mean.tolist(), fitted or None, std.tolist()))
    out.foldMetrics = metrics
    return out


def fold_models(data: DataFrame, whole, scalers: Sequence, lr: LogisticRegression, grid: Sequence, label: str = LABEL,
                parallelism: int = 6) -> list[list[LogisticRegressionModel]]:
    """Per fold, the logistic regression of each grid point on the rows of the other folds.

    ``data`` has (label, features, fold), ``whole`` is the scaler of all rows, ``scalers`` are those of the
    training parts. All parts with rows of both classes are fitted together (``shared_fit``), on blocks in the
    units of ``whole``, in which a part's own scaling is a change of a few numbers; the models are
    MLlib's, without its training summary. A part of one class alone, or with any other label, is left to MLlib.
    """
    counts = {(r[FOLD], r[label]): r["count"] for r in data.groupBy(FOLD, label).count().collect()}
    mean, std = whole.mean.toArray(), whole.std.toArray()
    unit = np.where(std > 0, std, 1.0)
    parts = {}
    for k, scaled in enumerate(scalers):
        of = {y: sum(n for (f, v), n in counts.items() if f != k and v == y) for _, y in counts}
        if {y for y, n in of.items() if n} == {0, 1}:
            own = scaled.std.toArray()
            inverse = np.divide(unit, own, out=np.zeros_like(own), where=own > 0)
            parts[k] = Part(of[0], of[1], np.where(std > 0, (scaled.mean.toArray() - mean) / unit, 0.0), inverse)
    found = {}
    if parts:
        level = StorageLevel.MEMORY_AND_DISK
        blocked = blocks(whole.transform(data), label, FOLD, sum(counts.values())).persist(level)
        try:
            points = [tuple(lr.copy(params).getOrDefault(p) for p in ("regParam", "elasticNetParam")) for params in grid]
            found = fit_all(blocked, parts, points, lr.getMaxIter(), lr.getTol())
        finally:
            blocked.unpersist()

    def mllib(k: int) -> list[LogisticRegressionModel]:
        train = scalers[k].transform(data.where(F.col(FOLD) != k)).select(label, "scaledFeatures").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPoolExecutor(max_workers=min(parallelism, len(grid))) as pool:
                return list(pool.map(lambda params: lr.fit(train, params), grid))
        finally:
            train.unpersist()

    def model(params, w: np.ndarray, b: float) -> LogisticRegressionModel:
        own = lr.copy(params)
        return own._copyValues(LogisticRegressionModel(JavaWrapper._new_java_obj(
            "org.apache.spark.ml.classification.LogisticRegressionModel", own.uid, Vectors.dense(w), b)))

    return [[model(params, w, b) for params, (w, b) in zip(grid, found[k])] if k in found else mllib(k)
            for k in range(len(scalers))]


def accuracies(scaled: DataFrame, models: Sequence, label: str = LABEL) -> tuple[int, list[float]]:
    """(rows, accuracy of each fitted logistic regression) on standardised rows, in one scan:
    the models become linear forms of the same vector, and one aggregate counts where each is right.

    Class 1 is a form above the log-odds of the model's threshold, as in MLlib. Without rows: 0 and NaNs.
    """
    rows = scaled.select(F.col(label).cast("double").alias("y"), vector_to_array("scaledFeatures").alias("z"))

    def right(m) -> Column:
        terms = [F.lit(float(w)) * F.col("z")[j] for j, w in enumerate(m.coefficients.toArray()) if w != 0.0]
        margin = functools.reduce(operator.add, terms, F.lit(float(m.intercept)))
        cut = math.log(m.getThreshold() / (1.0 - m.getThreshold()))
        return F.when(margin > F.lit(cut), 1.0).otherwise(0.0) == F.col("y")

    row = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(right(m)).alias(f"c{i}") for i, m in enumerate(models)]).first()
    n = row["n"]
    return n, [row[f"c{i}"] / n if n else math.nan for i in range(len(models))]


def cv_fold_metrics(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """``fold, regParam, elasticNetParam, n, accuracy``: what each fold's rows say of each grid point."""
    rows = []
    for k, (n, accuracy) in enumerate(cv_model.foldMetrics):
        for pm, value in zip(cv_model.getEstimatorParamMaps(), accuracy):
            named = {p.name: v for p, v in pm.items()}
            rows.append((k, float(named["regParam"]), float(named["elasticNetParam"]), n, float(value)))
    return spark.createDataFrame(
        rows, "fold int, regParam double, elasticNetParam double, n long, accuracy double")


def best_params(cv_model: CrossValidatorModel) -> tuple[float, float]:
    """(regParam, elasticNetParam) of the grid point that the refit on all rows uses."""
    named = {p.name: v for p, v in cv_model.getEstimatorParamMaps()[int(np.argmax(cv_model.avgMetrics))].items()}
    return float(named["regParam"]), float(named["elasticNetParam"])


def score(model, df: DataFrame) -> DataFrame:
    """The fitted pipeline's output: adds features, scaledFeatures, rawPrediction,
    probability, prediction."""
    return model.transform(df)


@dataclass
class LinearModel:
    """A fitted scaler + logistic regression folded into weights on raw columns."""
    features: tuple[str, ...]
    weights: tuple[float, ...]      # per raw feature
    intercept: float

    def margin(self) -> Column:
        """The linear form; a row with a null or NaN feature is an error that names
        it (as in MLlib's assembler), whatever its weight, never a class 0."""
        m = F.lit(self.intercept)
        for c, w in zip(self.features, self.weights):
            if w != 0.0:
                m = m + F.lit(w) * F.col(c).cast("double")
        void = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in self.features]
        names = F.concat_ws(", ", *[F.when(v, F.lit(c)) for v, c in zip(void, self.features)])
        error = F.raise_error(F.concat(F.lit("cannot score a row without a value in: "), names))
        return F.when(functools.reduce(operator.or_, void), error.cast("double")).otherwise(m)


def linear_model(model, features: Sequence[str] = FEATURES) -> LinearModel:
    """Fold ``(x - mean) / std`` and the coefficients into one linear form.

    margin = b + sum_j w_j (x_j - mu_j) / s_j
           = (b - sum_j w_j mu_j / s_j) + sum_j (w_j / s_j) x_j,  terms with s_j = 0 dropped
    """
    pm = model.bestModel if isinstance(model, CrossValidatorModel) else model
    stages = pm.stages if isinstance(pm, PipelineModel) else list(pm)
    sc, lr = stages[1], stages[2]
    mean, std = sc.mean.toArray(), sc.std.toArray()
    coef = lr.coefficients.toArray()
    weights, shift = [], 0.0
    for mu, s, w in zip(mean, std, coef):
        if s == 0.0:
            weights.append(0.0)
        else:
            weights.append(float(w / s))
            shift += float(w * mu / s)
    return LinearModel(tuple(features), tuple(weights), float(lr.intercept) - shift)


def with_linear_score(df: DataFrame, lm: LinearModel, threshold: float = 0.5) -> DataFrame:
    """Adds ``margin``, ``probability`` (of class 1) and ``prediction`` as plain columns."""
    cut = math.log(threshold / (1.0 - threshold))
    return df.withColumn("margin", lm.margin()).withColumns({
        "probability": F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))),
        PREDICTION: F.when(F.col("margin") > F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0)),
    })


def accuracy_metrics(pred: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: n, accuracy and the confusion counts (tp, tn, fp, fn), in one aggregate.

    Accuracy alone hides a constant predictor; the counts show it.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(y == p, 1.0).otherwise(0.0)).alias("accuracy"),
        F.count_if((y == 1.0) & (p == 1.0)).alias("tp"),
        F.count_if((y == 0.0) & (p == 0.0)).alias("tn"),
        F.count_if((y == 0.0) & (p == 1.0)).alias("fp"),
        F.count_if((y == 1.0) & (p == 0.0)).alias("fn"),
    )


def cv_grid_metrics(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """``regParam, elasticNetParam, mean_accuracy, std_accuracy`` per grid point."""
    rows = []
    std = getattr(cv_model, "stdMetrics", None) or [float("nan")] * len(cv_model.avgMetrics)
    for pm, avg, sd in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, std):
        named = {p.name: v for p, v in pm.items()}
        rows.append((float(named["regParam"]), float(named["elasticNetParam"]), float(avg), float(sd)))
    return spark.createDataFrame(
        rows, "regParam double, elasticNetParam double, mean_accuracy double, std_accuracy double")


def lr_coefficients(spark: SparkSession, model, features: Sequence[str] = FEATURES) -> DataFrame:
    """``term, coefficient`` of the fitted model on the scaled features, plus the intercept."""
    pm = model.bestModel if isinstance(model, CrossValidatorModel) else model
    lr = pm.stages[-1]
    rows = [(f, float(w)) for f, w in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "term string, coefficient double")


def optimality(spark: SparkSession, model: PipelineModel, df: DataFrame, reg: float, enet: float,
               label: str = LABEL, features: Sequence[str] = FEATURES, tolerance: float = 1e-4) -> DataFrame:
    """``term, gradient, coefficient, optimal``: whether the fit satisfies the
    first-order conditions of the penalised mean log-loss on the scaled features.

    With l1 = reg * enet and l2 = reg * (1 - enet), a coefficient w is optimal where
    g + l2 w + l1 sign(w) is 0, or, at w = 0, where |g| <= l1; the intercept
    where its gradient is 0. One aggregate over the scored rows.
    """
    rows = model.transform(df).select((vector_to_array("probability")[1] - F.col(label)).alias("r"),
                                      vector_to_array("scaledFeatures").alias("z"))
    grads = rows.agg(F.avg("r").alias("g"), *[F.avg(F.col("r") * F.col("z")[j]).alias(f"g{j}")
                                              for j in range(len(features))]).first()
    l1, l2, out = reg * enet, reg * (1 - enet), []
    for j, (f, w) in enumerate(zip(features, model.stages[-1].coefficients.toArray().tolist())):
        g = grads[f"g{j}"]
        good = abs(g) <= l1 + tolerance if w == 0 else abs(g + l2 * w + math.copysign(l1, w)) <= tolerance
        out.append((f, float(g), w, bool(good)))
    out.append(("intercept", float(grads["g"]), float(model.stages[-1].intercept), abs(grads["g"]) <= tolerance))
    return spark.createDataFrame(out, "term string, gradient double, coefficient double, optimal boolean")


def random_holdout(df: DataFrame, weights: Sequence[float] = HOLDOUT_WEIGHTS,
                   seed: int = HOLDOUT_SEED) -> tuple[DataFrame, DataFrame]:
    """The original 70/30 random split (rows depend on the partition layout)."""
    train, test = df.randomSplit(list(weights), seed)
    return train, test


def hash_holdout(df: DataFrame, id_col: str = ID) -> tuple[DataFrame, DataFrame]:
    """A layout-independent ~70/30 split by key: ``(id * 49979687) mod 1009 < 706``;
    rows with a null key go to the larger part.

    Its multiplier differs from the one that separates the training file from
    the file to score, so applied to a training file it still splits it."""
    flag = F.coalesce(hash_mod(id_col, 49979687, 1009) < F.lit(706), F.lit(True))
    return df.filter(flag), df.filter(~flag)


def split_key(df: DataFrame, seed: int = HOLDOUT_SEED, id_col: str = ID) -> Column:
    """A row's place in the seeded order, as 64 hex digits: 32 from its key, then 32 from the
    whole row, which part rows of one key (or of none)."""
    by_id = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    row = F.to_json(F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(df.columns)]))
    return F.concat(by_id, F.md5(F.coalesce(row, F.lit(""))))


def exact_holdout(df: DataFrame, fraction: str = "0.7", seed: int = HOLDOUT_SEED,
                  id_col: str = ID) -> tuple[DataFrame, DataFrame]:
    """A split that reproduces: of n rows exactly ``floor(fraction * n)``, those first in a
    seeded order of the keys, and the rest. The same rows on any layout.

    Nothing is sorted: rows are counted by the first three digits of their place
    (4,096 counts), then by the next three inside the one prefix that the cut
    falls into, until it falls between two. Rows of one key are ordered by a hash of the whole
    row; of rows equal in every column, which no order can tell apart, as many as are needed are
    taken by count. A null key is a key like any other.
    """
    step, key = 3, split_key(df, seed, id_col)
    total = df.count()
    room, prefix = int(Fraction(fraction) * total), ""
    if room >= total:
        return df, df.limit(0)
    while True:
        part = key.substr(len(prefix) + 1, step)
        inside = df.where(key.startswith(prefix)) if prefix else df
        counts = sorted((r["part"], r["n"]) for r in inside.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        upto = list(itertools.accumulate(n for _, n in counts))
        at = next(i for i, u in enumerate(upto) if u > room)   # the first part that is not taken whole
        room -= upto[at] - counts[at][1]
        prefix += counts[at][0]
        if not room:
            return df.where(key < prefix), df.where(key >= prefix)
        if len(prefix) == 64:   # equal rows only
            break
    equal = (df.where(key == prefix).groupBy(*[F.col(f"`{c}`") for c in df.columns])
             .agg(F.count(F.lit(1)).alias("__n")))
    first, rest = (equal.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.sequence(F.lit(1), times)).alias("__i"))
                   .drop("__i") for times in (F.lit(room), F.col("__n") - room))
    return df.where(key < prefix).unionByName(first), df.where(key > prefix).unionByName(rest)


def holdout_metrics(df: DataFrame, split: str = "hash", parallelism: int = 6,
                    **fit_args) -> tuple[DataFrame, CrossValidatorModel]:
    """Split (``hash``, ``exact`` or ``random``), cross-validate on the larger part, score the
    hold-out, measure it."""
    train, test = {"random": random_holdout, "exact": exact_holdout, "hash": hash_holdout}[split](df)
    model = fit_cv(train, parallelism=parallelism, **fit_args)
    return accuracy_metrics(score(model, test)), model

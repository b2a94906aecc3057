"""Churn classifier and demand forecast as Spark jobs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import FEATURE_COLUMNS
from orderlake.operators.keyed import map_groups, ranks, running_sums
from orderlake.session import scratch

LEAKY = ["days_since_last_order"]
MIN_ROWS = 10
MIN_POINTS = 14
ROWS_PER_TASK = 50_000
BAND_80 = 1.2815515655446004
AROUND = 366


def model_features(exclude_leaky: bool = False) -> list[str]:
    """``days_since_last_order`` alone decides the label, so metrics with and without it are both worth reporting."""
    return [c for c in FEATURE_COLUMNS if not (exclude_leaky and c in LEAKY)]


def training_rows(features: DataFrame, folds: int, seed: int = 42) -> DataFrame:
    """Label, class weight and an exactly stratified fold per row.

    The fold is the row's position inside its label, in a hashed order, modulo ``folds``. Positions come from the two-level
    ranking, so the (two) labels are not two tasks.
    """
    rows = features.select("user_id_hash", F.col("is_churned").cast("double").alias("label"),
                           *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURE_COLUMNS])
    rows = rows.withColumn("_h", F.xxhash64("user_id_hash", F.lit(seed)))
    ranked = ranks(rows, ["label"], ["_h", "user_id_hash"], F.shiftright("_h", 54).cast("bigint"), "position")
    counts = rows.agg(F.count_if(F.col("label") == 0.0).alias("neg"), F.count_if(F.col("label") == 1.0).alias("pos"))
    weight = counts.select(F.col("neg") / F.greatest(F.lit(1), F.col("pos"))).scalar()
    return ranked.withColumns({
        "fold": (F.col("position") % folds).cast("int"),
        "weight": F.when(F.col("label") == 1.0, weight).otherwise(F.lit(1.0)),
    }).drop("_h", "position")


def _estimator(names: list[str], trees: int) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=4, stepSize=0.05,
                      subsamplingRate=0.8, minInstancesPerNode=5, seed=42),
    ])


def _scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select("user_id_hash", "label", "fold", vector_to_array("probability")[1].alias("p"))


def fold_metrics(scored: DataFrame) -> DataFrame:
    """AUC, F1, precision and recall per fold. AUC is the rank-sum form over distinct scores, with ties counted half."""
    levels = scored.groupBy("fold", "p").agg(F.count_if(F.col("label") == 1.0).alias("pos"), F.count_if(F.col("label") == 0.0).alias("neg"))
    summed = running_sums(levels, ["fold"], ["p"], F.floor(F.col("p") * F.lit(1024.0)).cast("bigint"), {"below": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") * F.lit(0.5)))
    auc = summed.groupBy("fold").agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("roc_auc"))
    hit = F.col("p") > 0.5
    counts = scored.groupBy("fold").agg(
        F.count_if(hit & (F.col("label") == 1.0)).alias("tp"), F.count_if(hit & (F.col("label") == 0.0)).alias("fp"),
        F.count_if(~hit & (F.col("label") == 1.0)).alias("fn"))

    def ratio(n: Column, d: Column) -> Column:
        return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.join(auc, "fold").select(
        "fold", "roc_auc", ratio(tp * 2, tp * 2 + fp + fn).alias("f1"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"))


def train_churn(features: DataFrame, trees: int = 200, folds: int = 5, exclude_leaky: bool = False) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated boosted trees, then a fit on all rows. Returns the model and a (metric, mean, std) table that also lists
    feature importances."""
    spark = features.sparkSession
    # Every job plans its whole lineage anew, so the rows are written once, and what thousands of jobs go back to is a scan.
    ranked, path = training_rows(features, folds), scratch(spark, "training")
    ranked.write.parquet(path)
    rows = spark.read.schema(ranked.schema).parquet(path)
    total = rows.count()
    # A tree is some five passes over the rows, each a job: few tasks a job, and all fits side by side, so their jobs fill the cluster together.
    rows = rows.coalesce(max(1, min(spark.sparkContext.defaultParallelism, total // ROWS_PER_TASK))).persist()
    try:
        if total < MIN_ROWS:
            raise ValueError(f"need at least {MIN_ROWS} training rows")
        names = model_features(exclude_leaky)

        def fit(fold: int) -> PipelineModel:
            return _estimator(names, trees).fit(rows.filter(F.col("fold") != fold))

        with ThreadPoolExecutor(folds + 1) as pool:
            # Fold ``folds`` doesn't occur, so that fit takes all rows.
            *models, final = pool.map(inheritable_thread_target(spark)(fit), range(folds + 1))
        scored = None
        for fold, model in enumerate(models):
            part = _scores(model, rows.filter(F.col("fold") == fold))
            scored = part if scored is None else scored.unionByName(part)
        metrics = ["roc_auc", "f1", "precision", "recall"]
        pairs = F.array(*[F.struct(F.lit(f"cv_{m}").alias("metric"), F.col(m).alias("value")) for m in metrics])
        table = fold_metrics(scored).select(F.inline(pairs)).groupBy("metric").agg(
            F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).collect()
        importances = zip(names, final.stages[-1].featureImportances.toArray())
        listed = [(r["metric"], r["mean"], r["std"]) for r in table] + [(f"feature_importance_{n}", float(v), None) for n, v in importances]
        return final, spark.createDataFrame(listed, "metric string, mean double, std double")
    finally:
        rows.unpersist()


def fit_churn(features: DataFrame, path: str, trees: int = 200, exclude_leaky: bool = False) -> None:
    """Fit on all rows and save the model, for other jobs to score with."""
    _estimator(model_features(exclude_leaky), trees).fit(training_rows(features, 1)).write().overwrite().save(path)


def load_churn(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_churn(model: PipelineModel, features: DataFrame) -> DataFrame:
    rows = features.select("user_id_hash", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURE_COLUMNS])
    return model.transform(rows).select("user_id_hash", vector_to_array("probability")[1].alias("churn_probability"))


def _waves(days: np.ndarray) -> np.ndarray:
    """Weekly and yearly Fourier terms, which depend on the day alone."""
    columns = []
    for period, order in ((7.0, 3), (365.25, 10)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def _trend(days: np.ndarray, origin: int, span: float) -> np.ndarray:
    """Trend with a few possible bends."""
    t = (days - origin) / span
    return np.column_stack([np.ones_like(t), t, *[np.maximum(0.0, t - bend) for bend in np.linspace(0.1, 0.8, 8)]])


def forecast_demand(daily: DataFrame, keys: list[str], horizon: int = 30) -> DataFrame:
    """Fitted and future demand per series: yhat with an 80 % band, clipped at zero, one decimal.

    ``daily`` has one row per (series, day), so a group is bounded by the calendar whatever the number of orders. Days between the first and
    the last without a row count as no demand. A series with fewer than 14 rows isn't fitted: its own days come back with ``status``
    ``too_short`` and no values; all others are ``ok``. A NULL key is a series like any other.
    """

    known: dict = {}

    def waves(first: int, last: int) -> np.ndarray:
        """Terms of the days of a series; neighbouring series share most of their days, so a task keeps them."""
        if not known or first < known["first"] or last > known["last"]:
            known.update(first=first - AROUND, last=last + AROUND, terms=_waves(np.arange(first - AROUND, last + AROUND + 1).astype(float)))
        return known["terms"][first - known["first"] : last - known["first"] + 1]

    def fit(key: tuple, columns: dict) -> dict | None:
        seen = np.array(columns["ds"], dtype="datetime64[D]").astype("int64")
        if len(seen) < MIN_POINTS:
            none = [None] * len(seen)
            return {"ds": seen.astype("datetime64[D]"), "yhat": none, "yhat_lower": none, "yhat_upper": none, "is_future": [False] * len(seen)}
        first, last = int(seen[0]), int(seen[-1])
        ahead = np.arange(first, last + horizon + 1)
        y = np.zeros(last - first + 1)
        np.add.at(y, seen - first, columns["y"].astype(float))
        span = max(1.0, float(last - first))
        terms = np.concatenate([_trend(ahead.astype(float), first, span), waves(first, last + horizon)], axis=1)
        x = terms[: len(y)]
        penalty = np.diag([1e-9, 1e-9, *[1.0] * 8, *[0.1] * (x.shape[1] - 10)])
        beta = np.linalg.solve(x.T @ x + penalty, x.T @ y)
        band = BAND_80 * float(np.std(y - x @ beta))
        yhat = terms @ beta

        def shown(values: np.ndarray) -> np.ndarray:
            return np.maximum(0, values).round(1)

        return {"ds": ahead.astype("datetime64[D]"), "yhat": shown(yhat), "yhat_lower": shown(yhat - band), "yhat_upper": shown(yhat + band), "is_future": ahead > last}

    fitted = map_groups(daily.filter(F.col("ds").isNotNull()), keys, ["ds"], "ds date, yhat double, yhat_lower double, yhat_upper double, is_future boolean", fit)
    return fitted.withColumn("status", F.when(F.col("yhat").isNull(), "too_short").otherwise("ok"))

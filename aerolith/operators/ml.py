"""Model training, scoring, ranking and persistence with Spark ML (ML1-ML10, TS5 with MLlib, TS10).

Every estimator is distributed MLlib; the driver only deals the
handful of model specifications (ML6) to a few threads, as many as leave
each fit its cores, timing each fit and recording failures instead of
aborting. Evaluation stacks all models' predictions as
(model, y, y_hat) and computes the metrics in one aggregation (ML8).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators.monitoring import regression_metrics

# Model input columns of the reference training table.
CATEGORICAL_FEATURES = ["city", "day_of_week", "season"]
NUMERIC_FEATURES = ["pm2_5", "pm10", "temperature", "us_aqi", "hour", "day", "month", "is_weekend",
                    "aqi_lag_1", "aqi_lag_3", "aqi_lag_6", "aqi_lag_24", "aqi_roll_3", "aqi_roll_6", "aqi_roll_24"]
TARGET = "target_aqi"
RIDGE_ALPHA = 1.0


@dataclass
class ModelSpec:
    name: str
    kind: str                      # ridge | random_forest | gbt
    params: dict = field(default_factory=dict)


def default_specs() -> list[ModelSpec]:
    """ML3/ML4/ML5: ridge, random forest and gradient boosting at the reference sizes."""
    return [ModelSpec("Ridge", "ridge"),
            ModelSpec("RandomForest", "random_forest", {"numTrees": 300, "maxDepth": 20, "seed": 42}),
            ModelSpec("GradientBoosting", "gbt", {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "seed": 42})]


#: How trees are grown, not what they are: node ids are kept with the rows, so a level's tasks do not carry the forest; lineage is cut
#: every few iterations; many nodes share a pass.
GROWING = {"random_forest": {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024},
           "gbt": {"checkpointInterval": 10, "maxMemoryInMB": 1024}}
#: rows of a training partition at least: each level of each tree is a job, and a small table in many partitions is all scheduling
ROWS_PER_PARTITION = 100_000
#: a forest is grown as one part for every so many rows, in parts of equal numbers of trees: deep trees have nodes in proportion to the
#: rows, and a fit has only as many tasks as the table has partitions. Up to that many rows it is one MLlib forest.
ROWS_PER_FOREST_PART = 5_000
FOREST_PARTS = 12


def preprocessor_stages(categorical=CATEGORICAL_FEATURES, numeric=NUMERIC_FEATURES):
    """ML1: one-hot encode categoricals and assemble with numeric columns.

    Unknown and NULL values get the indexer's last index, whose slot is dropped, so they light none.
    """
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                        dropLast=True, handleInvalid="error")
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}_ohe" for c in categorical], outputCol="features",
                          handleInvalid="keep")
    return [*idx, ohe, asm]


def ridge_reg_param(train: DataFrame, alpha: float = RIDGE_ALPHA, label: str = TARGET) -> float:
    """ML3: MLlib's regParam equivalent to a closed-form ridge penalty ``alpha`` (one aggregate)."""
    r = train.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return float(alpha) * float(r["s"] or 0.0) / max(int(r["n"]), 1)


def fit_slots(train: DataFrame) -> int:
    """How many fits on ``train`` can run at once without waiting for each other's tasks."""
    return max(1, train.sparkSession.sparkContext.defaultParallelism // train.rdd.getNumPartitions())


def in_threads(spark, workers: int, calls: list) -> list:
    """The results of ``calls``, at most ``workers`` at a time; the first error is raised when all have ended."""
    with ThreadPoolExecutor(max(1, workers)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [r.result() for r in running]


def forest_parts(rows: int, trees: int) -> int:
    """The number of parts of a forest: the largest divisor of ``trees`` that the rows call for, so that parts weigh the same."""
    most = min(FOREST_PARTS, max(1, -(-rows // ROWS_PER_FOREST_PART)))
    return max(k for k in range(1, most + 1) if trees % k == 0)


class ForestInParts(Estimator):
    """ML4: a random forest grown as ``parts`` MLlib forests, ``workers`` at a time; the prediction is the mean over all trees."""

    def __init__(self, params: dict, parts: int, label: str, workers: int):
        super().__init__()
        self.params_, self.parts, self.label, self.workers = params, parts, label, workers

    def forest(self, k: int) -> RandomForestRegressor:
        """Part ``k``, with seeds of its own: MLlib draws a partition's bootstrap from seed + its number + 1, hence the wide steps."""
        growing = GROWING["random_forest"] | {"maxMemoryInMB": max(64, GROWING["random_forest"]["maxMemoryInMB"] // self.parts)}
        own = {"numTrees": self.params_["numTrees"] // self.parts, "seed": self.params_.get("seed", 0) + 1_000_003 * k}
        return RandomForestRegressor(featuresCol="features", labelCol=self.label, predictionCol=f"prediction_{k}",
                                     **growing, **(self.params_ | own))

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        forests = in_threads(dataset.sparkSession, self.workers, [lambda k=k: self.forest(k).fit(dataset) for k in range(self.parts)])
        names = [f"prediction_{k}" for k in range(self.parts)]
        mean = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), ({' + '.join(names)}) / {self.parts}D AS prediction FROM __THIS__")
        return PipelineModel([*forests, mean])


def estimator(spec: ModelSpec, train: DataFrame, label: str = TARGET):
    if spec.kind == "ridge":
        return LinearRegression(featuresCol="features", labelCol=label, regParam=ridge_reg_param(train, label=label),
                                elasticNetParam=0.0, standardization=False, solver="normal")
    if spec.kind == "random_forest":
        parts = forest_parts(train.count(), spec.params.get("numTrees", 20))
        if parts > 1:
            return ForestInParts(spec.params, parts, label, max(1, fit_slots(train) - 1))   # one slot is the other models'
        return RandomForestRegressor(featuresCol="features", labelCol=label, **GROWING[spec.kind], **spec.params)
    if spec.kind == "gbt":
        return GBTRegressor(featuresCol="features", labelCol=label, **GROWING[spec.kind], **spec.params)
    raise ValueError(f"unknown model kind {spec.kind}")


def build_pipeline(spec: ModelSpec, train: DataFrame, categorical=CATEGORICAL_FEATURES,
                   numeric=NUMERIC_FEATURES, label: str = TARGET) -> Pipeline:
    """ML2: preprocessor + estimator."""
    return Pipeline(stages=[*preprocessor_stages(categorical, numeric), estimator(spec, train, label)])


def training_rows(train: DataFrame) -> DataFrame:
    """``train`` in as many partitions as its rows call for, materialised: estimators read it many times."""
    from aerolith.session import cut_lineage

    n = train.count()
    parts = max(2, -(-n // ROWS_PER_PARTITION))
    return cut_lineage(train.coalesce(parts) if parts < train.rdd.getNumPartitions() else train.repartition(parts))


def train_models(train: DataFrame, specs: list[ModelSpec], label: str = TARGET, store: str | None = None, **kw):
    """ML6: fit every spec once per training table (``model_store.fit_once``); a failing model is recorded and skipped.

    Returns (fitted {name: PipelineModel}, summary DataFrame with a row for every spec).
    """
    from aerolith.operators import model_store

    spark = train.sparkSession
    train = training_rows(train)
    digest = model_store.data_digest(train)
    def fit(spec):
        t0 = time.perf_counter()
        try:
            what = {"kind": spec.kind, "params": spec.params, "label": label, **{k: list(v) for k, v in kw.items()}}
            fit = model_store.fit_once(build_pipeline(spec, train, label=label, **kw), train, what, store, digest)
            return fit.model, (spec.name, spec.kind, fit.seconds, "trained", None)
        except Exception as err:  # noqa: BLE001 - continue with the other models
            return None, (spec.name, spec.kind, round(time.perf_counter() - t0, 3), "failed", str(err))

    # two at a time: boosting is a long row of short jobs, during which the forest has the other cores
    done = in_threads(spark, min(2, fit_slots(train)), [lambda s=s: fit(s) for s in specs])
    fitted = {row[0]: model for model, row in done if model is not None}
    rows = [row for _, row in done]
    summary = spark.createDataFrame(rows, "model string, kind string, fit_seconds double, status string, error string")
    return fitted, summary


def stacked_predictions(models: dict[str, PipelineModel], df: DataFrame, label: str = TARGET) -> DataFrame:
    """ML7: score ``df`` with every model; (model, key columns, y, y_hat) stacked in one frame."""
    out = None
    for name, m in models.items():
        p = m.transform(df).select(F.lit(name).alias("model"), *[c for c in ("city", "timestamp") if c in df.columns],
                                   F.col(label).cast("double").alias("y"), F.col("prediction").alias("y_hat"))
        out = p if out is None else out.unionByName(p)
    return out


def rank_models(preds: DataFrame) -> DataFrame:
    """ML8/WN7: MAE/RMSE/R2 per model in one aggregation, ranked by RMSE (1 = best)."""
    from pyspark.sql import Window
    m = regression_metrics(preds, "y", "y_hat", groups=["model"])
    return m.withColumn("rank", F.row_number().over(Window.orderBy("rmse", "model")).cast("bigint"))


def compare_models(models: dict[str, PipelineModel], test: DataFrame, label: str = TARGET,
                   fit_summary: DataFrame | None = None) -> DataFrame:
    """ML9: MAE/RMSE/R2/MAPE and scoring time per model, ranked by RMSE; the best one is ``selected``.

    Each model scores ``test`` once, into a stored table, which is what is timed and what the metrics are computed
    from, in one aggregation over (model, y, y_hat). Models of ``fit_summary`` that failed are rows without metrics.
    """
    from pyspark.sql import Window

    from aerolith.operators.monitoring import mape
    from aerolith.sources.io import scratch_dir

    spark = test.sparkSession
    folder, timings = scratch_dir(spark, "scored"), []
    for name in models:
        t0 = time.perf_counter()
        stacked_predictions({name: models[name]}, test, label).select("y", "y_hat").write.parquet(f"{folder}/model={name}")
        timings.append((name, round(time.perf_counter() - t0, 3)))
    preds = spark.read.schema("y double, y_hat double, model string").option("basePath", folder).parquet(*[f"{folder}/model={m}" for m in models])
    extra = {"mape": F.round(mape(preds, "y", "y_hat"), 4)}
    # one row per model: the final ranking is over the number of models
    ranked = regression_metrics(preds, "y", "y_hat", groups=["model"], extra=extra).withColumn(
        "rank", F.row_number().over(Window.orderBy("rmse", "model")).cast("bigint"))
    times = spark.createDataFrame(timings, "model string, scoring_seconds double")
    out = ranked.join(times, "model", "left")
    if fit_summary is not None:
        out = fit_summary.select("model", "fit_seconds", "status").join(out, "model", "left")
    return out.withColumn("selected", F.coalesce(F.col("rank") == 1, F.lit(False)))


def model_columns(model: PipelineModel) -> list[str]:
    """PR8: the raw columns that a fitted pipeline reads, in its order: encoded ones first, then those of the assembler."""
    made, out = set(), []
    for stage in model.stages:
        names = lambda one, many: (([stage.getOrDefault(one)] if stage.hasParam(one) and stage.isDefined(one) else [])  # noqa: E731,B023
                                   + (list(stage.getOrDefault(many)) if stage.hasParam(many) and stage.isDefined(many) else []))  # noqa: B023
        out += [c for c in names("inputCol", "inputCols") if c not in made and c not in out]
        made |= set(names("outputCol", "outputCols"))
    return out


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    """ML10: persist with MLlib's writer and load it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def linear_coefficients(model: PipelineModel) -> tuple[float, list[float]]:
    """Intercept and weights of the final linear stage (a vector of #features doubles)."""
    lr = model.stages[-1]
    return float(lr.intercept), [float(x) for x in lr.coefficients]


def fit_state_model(train: DataFrame, features: list[str], label: str = TARGET, kind: str = "ridge",
                    params: dict | None = None) -> PipelineModel:
    """Model over numeric ``features`` only (inputs of the recursive forecast)."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    from aerolith.operators import model_store

    spec = ModelSpec(kind, kind, params or {})
    train = training_rows(train)
    what = {"kind": kind, "params": spec.params, "label": label, "features": list(features)}
    return model_store.fit_once(Pipeline(stages=[asm, estimator(spec, train, label)]), train, what).model


def sequence_vectors(seq: DataFrame, history: str = "history") -> DataFrame:
    """TS10: array<double> history -> ML vector column ``features``."""
    return seq.withColumn("features", array_to_vector(F.col(history).cast("array<double>")))

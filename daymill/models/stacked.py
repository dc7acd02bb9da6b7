"""Stacked forecaster: boosted trees and the seasonal model, blended per (city, horizon)."""

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import workspace
from daymill.constants import HORIZONS, target_name
from daymill.functions.text import model_name
from daymill.models import forest
from daymill.models.seasonal import fit_seasonal, predict_seasonal, seasonal_value
from daymill.models.trees import (
    LEVEL,
    PARALLELISM,
    SEED,
    TreeParams,
    city_levels,
    fit_inputs,
    fit_trees,
    with_levels,
)
from daymill.operators.metrics import apply_blend, best_by_error, fit_blend, regression_metrics

KEYS = ["city", "horizon"]


@dataclass
class StackedForecaster:
    inputs: PipelineModel
    trees: dict[int, GBTRegressionModel]
    levels: DataFrame
    seasonal: DataFrame
    blend: DataFrame | None = None

    def base_predictions(self, features: DataFrame) -> DataFrame:
        """One row per (row, horizon) with `tree` and `seasonal` predictions, and `target` where
        the features carry targets. All horizons are scored in one pass over the features."""
        scored = self.inputs.transform(with_levels(features, self.levels))
        for model in self.trees.values():
            scored = model.transform(scored)

        def pair(h):
            target = F.col(target_name(h)) if target_name(h) in features.columns else F.lit(None).cast("double")
            return F.struct(
                F.lit(h).alias("horizon"), F.col(f"tree_{h}d").alias("tree"), target.alias("target")
            )

        long = scored.select("city", "date", F.inline(F.array(*[pair(h) for h in self.trees])))
        dated = long.withColumn("seasonal_date", F.date_add("date", F.col("horizon")))
        return predict_seasonal(dated, self.seasonal, "seasonal_date")

    def predict(self, features: DataFrame) -> DataFrame:
        """(city, date, horizon, seasonal_date, predicted, ...) for every feature row."""
        return apply_blend(self.base_predictions(features), self.blend, KEYS, "tree", "seasonal")

    def save(self, path: str) -> None:
        self.inputs.save(f"{path}/inputs")
        with ThreadPool(PARALLELISM) as pool:
            pool.map(lambda item: item[1].save(f"{path}/trees/horizon={item[0]}"), self.trees.items())
        self.levels.write.parquet(f"{path}/levels")
        self.seasonal.write.parquet(f"{path}/seasonal")
        self.blend.write.parquet(f"{path}/blend")
        forest.store(self.levels.sparkSession, path, self.trees)

    @staticmethod
    def load(spark: SparkSession, path: str, horizons=HORIZONS) -> "StackedForecaster":
        def one(horizon):
            return horizon, GBTRegressionModel.load(f"{path}/trees/horizon={horizon}")

        with ThreadPool(PARALLELISM) as pool:
            models = dict(pool.map(one, horizons))
        return StackedForecaster(
            PipelineModel.load(f"{path}/inputs"),
            models,
            *[spark.read.parquet(f"{path}/{part}") for part in ("levels", "seasonal", "blend")],
        )


def fit_stacked(
    frame: DataFrame, params: dict[int, TreeParams], seed: int = SEED, parallelism: int = PARALLELISM
) -> StackedForecaster:
    """Fit on a training frame with its `split` column: trees and seasonal model on train, blend
    on meta. The frame is read many times, so hand in a stored table (workspace.materialize)."""
    train = frame.filter("split = 'train'")
    levels = workspace.materialize(city_levels(train), "levels")
    inputs = fit_inputs(with_levels(train, levels))
    labels = [target_name(h) for h in params]
    vectors = inputs.transform(with_levels(train, levels)).select("features", *labels)
    vectors = workspace.materialize(vectors, "vectors")
    with ThreadPool(parallelism) as pool:
        fits = pool.map(lambda h: (h, fit_trees(vectors, h, params[h], seed)), sorted(params))
    seasonal = workspace.materialize(fit_seasonal(train), "seasonal")
    forecaster = StackedForecaster(inputs, dict(fits), levels, seasonal)
    meta = forecaster.base_predictions(frame.filter("split = 'meta'"))
    blend = fit_blend(meta, KEYS, "tree", "seasonal", "target")
    forecaster.blend = workspace.materialize(blend, "blend")
    return forecaster


def evaluate(forecaster: StackedForecaster, frame: DataFrame) -> DataFrame:
    """Errors on the test split per (city, horizon)."""
    scored = forecaster.predict(frame.filter("split = 'test'"))
    return regression_metrics(scored, KEYS, actual="target")


def run_rows(errors: DataFrame, params: dict[int, TreeParams], run_order: int, path: str) -> DataFrame:
    """One run-log row per model: name, parameters, errors and where the forecaster is stored."""
    spark = errors.sparkSession
    table = spark.createDataFrame(
        [(h, p.trees, p.learning_rate, p.depth, p.row_sample, p.column_sample) for h, p in params.items()],
        "horizon int, trees int, learning_rate double, depth int, row_sample double, column_sample double",
    )
    return errors.join(table, "horizon").select(
        model_name(F.col("city"), F.col("horizon")).alias("model"),
        F.lit(run_order).cast("bigint").alias("run_order"),
        "city",
        "horizon",
        "trees",
        "learning_rate",
        "depth",
        "row_sample",
        "column_sample",
        "rmse",
        "mae",
        "r2",
        F.lit(path).alias("path"),
    )


def champions(runs: DataFrame) -> DataFrame:
    """The run in production for each model: lowest error, the older one on a tie."""
    return best_by_error(runs, ["model"], "run_order")


def predict_with_champions(
    spark: SparkSession, features: DataFrame, champion_rows: DataFrame, horizons=HORIZONS
) -> DataFrame:
    """Score each city and horizon with its champion, all stored forecasters in one plan: their trees, levels, seasonal
    coefficients and blends are read as rows (see daymill.models.forest), and a feature row meets those of the runs
    that lead its city only. Champions without stored rows raise; `forest.store` writes them for a forecaster that has none."""
    wanted = champion_rows.filter(F.col("horizon").isin(list(horizons))).select("city", F.col("horizon").cast("int").alias("horizon"), "path")
    paths = [r.path for r in wanted.select("path").distinct().toLocalIterator()]
    if not paths:
        raise ValueError("no champion to forecast with")
    part = lambda name: forest.of_runs(spark, paths, name)
    runs = [wanted.join(part("levels"), ["path", "city"], "left"), part("forest_inputs")]
    mine = features.drop(LEVEL).join(runs[0], "city").join(runs[1], "path")
    vectors = mine.select("city", "date", "horizon", "path", forest.vector().alias("vector"))
    scored = forest.score(vectors, part("forest"))
    dated = scored.withColumn("seasonal_date", F.date_add("date", F.col("horizon")))
    seasonal = dated.join(part("seasonal"), ["path", "city"], "left").withColumn(
        "seasonal", seasonal_value(F.col("seasonal_date"), F.col("coefficients"))
    )
    blended = apply_blend(seasonal.drop("coefficients"), part("blend"), ["path", *KEYS], "tree", "seasonal")
    return blended.drop("path")

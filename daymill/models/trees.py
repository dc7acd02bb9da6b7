"""Boosted trees as MLlib has them: one fit per horizon over all cities, and a random search."""

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymill import workspace
from daymill.constants import (
    CALENDAR_FEATURES,
    MODEL_FEATURES,
    TRIAL_COUNT,
    TRIAL_RANGES,
    target_name,
)
from daymill.models import boosting
from daymill.models.boosting import _grid
from daymill.operators.aggregate import first_per_key
from daymill.operators.metrics import regression_metrics

LEVEL = "city_level"
NULLABLE = [f for f in MODEL_FEATURES if f not in CALENDAR_FEATURES] + [LEVEL]
SEED = 42
STORED = 10  # trees between two writes of their sum
TASK_CELLS = 1 << 23  # rows times features that one task boosts, some 190,000 rows; at most some 300 MB of a worker's memory
PARALLELISM = 4  # fits, saves and loads under way at a time; each is a distributed job


@dataclass(frozen=True)
class TreeParams:
    trees: int = 100
    learning_rate: float = 0.1
    depth: int = 5
    row_sample: float = 1.0
    column_sample: float = 1.0


def city_levels(train: DataFrame) -> DataFrame:
    """Mean value of each city in the training split. It tells the one model which city it looks
    at, for any number of cities, where an index would need a category per city."""
    return _summable(train.select("city", "pm10"), ["pm10"]).groupBy("city").agg(F.avg("pm10").alias(LEVEL))


def with_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    return df.drop(LEVEL).join(levels, "city", "left")


def fit_inputs(train: DataFrame) -> PipelineModel:
    """Feature vector for all horizons. MLlib trees take no nulls, so each nullable feature gets
    a was-null flag and its training mean."""
    present = train.agg(*[F.count(c).alias(c) for c in NULLABLE]).first()
    kept = [c for c in NULLABLE if present[c]]
    flags = ", ".join(f"CAST(isnull({c}) AS DOUBLE) AS {c}_missing" for c in kept)
    filled = [f"{c}_filled" for c in kept]
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__"),
            Imputer(inputCols=kept, outputCols=filled, strategy="mean"),
            VectorAssembler(
                inputCols=filled + [f"{c}_missing" for c in kept] + CALENDAR_FEATURES,
                outputCol="features",
            ),
        ]
    ).fit(_summable(train, kept))


def _on_grid(value: Column, grid: float) -> Column:
    return F.rint(value / grid) * grid if grid else value


def _summable(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns on grids on which their sums, and so their means, are exact."""
    sizes = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.max(F.abs(c)).cast("double").alias(c) for c in columns]).first()
    return df.withColumns({c: _on_grid(F.col(c).cast("double"), _grid(sizes[c], sizes["_rows"], 1)) for c in columns})


def _ensemble(spark: SparkSession, trees: list, weights: list[float], name: str) -> GBTRegressionModel:
    gateway = spark.sparkContext._gateway
    made = spark.sparkContext._jvm.org.apache.spark.ml.regression
    held = gateway.new_array(made.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        held[i], shares[i] = tree, weight
    model = made.GBTRegressionModel(f"GBTRegressor_{uuid.uuid4().hex[:12]}", held, shares)
    return GBTRegressionModel(model.setFeaturesCol("features").setPredictionCol(name))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the values of the vector, and a hash of the row, by which trees draw their samples."""
    return rows.withColumn("_x", vector_to_array("features")).withColumn("_row", F.xxhash64("_x", "_label"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in tasks and in an order that their values alone decide: MLlib draws the candidates of splits by task and place."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _keyed(rows).repartition(tasks, "_row").sortWithinPartitions("_row", "_x", "_label").drop("_x")


def fit_trees(vectors: DataFrame, horizon: int, params: TreeParams, seed: int = SEED) -> GBTRegressionModel:
    """Boosting as GBTRegressor does it, tree by tree, so that the same rows give the same trees in any order and dealing.

    GBTRegressor adds residuals up in the order in which blocks arrive, and last digits decide among splits that part the
    rows alike. Here the residuals of each tree lie on a grid on which their sums are exact. The sample of a tree goes by a hash of
    the row. Up to TASK_CELLS, one task boosts all rows of the horizon (`boosting`), in a few jobs; more rows stay where they
    are, and MLlib's learner grows the trees level by level. Both give the same trees; only where MLlib looks for thresholds
    in a sample (over 10,000 rows) does the task take all rows.
    """
    label = target_name(horizon)
    rows = vectors.select("features", F.col(label).cast("double").alias("_label")).filter(F.col(label).isNotNull())
    learner = RandomForestRegressor(
        labelCol="_residual", featuresCol="features", numTrees=1, bootstrap=False, subsamplingRate=1.0, maxDepth=params.depth,
        featureSubsetStrategy=str(params.column_sample) if params.column_sample < 1 else "all",
    )
    fit = _boost_in_a_task if params.trees > 0 and _fits_a_task(rows) else _boost_by_levels
    return fit(rows, learner, params, seed, f"tree_{horizon}d")


def _fits_a_task(rows: DataFrame) -> bool:
    """Rows of one width and at most TASK_CELLS, with finite values; the others MLlib takes or refuses."""
    x = vector_to_array("features")
    finite = lambda v: ~F.isnan(v) & (F.abs(v) < float("inf"))
    sound = F.coalesce(F.forall(x, finite) & finite(F.col("_label")), F.lit(False))
    width = F.size(x)
    cells, least, most, all_sound = rows.agg(F.sum(width), F.min(width), F.max(width), F.every(sound)).first()
    return bool(all_sound) and least == most and 0 < cells <= TASK_CELLS


def _drawn(params: TreeParams, seed) -> Column:
    """Whether the tree of this seed takes a row."""
    return F.pmod(F.xxhash64("_row", seed), F.lit(1 << 30)) < int(params.row_sample * (1 << 30))


def _boost_in_a_task(rows: DataFrame, learner: RandomForestRegressor, params: TreeParams, seed: int, name: str) -> GBTRegressionModel:
    """All rows in one task, which writes the trees in MLlib's layout of stored ones."""
    spark = rows.sparkSession
    path = workspace.new_path(spark, "trees")
    columns = [vector_to_array("features").alias("x"), F.col("_label").alias("label")]
    if params.row_sample < 1:
        numbers = F.sequence(F.lit(seed), F.lit(seed + params.trees - 1))
        columns.append(F.transform(numbers, lambda number: _drawn(params, number)).alias("drawn"))
    given = _keyed(rows).select(*columns).repartition(1)
    given.mapInArrow(boosting.booster(**asdict(params), seed=seed), boosting.NODES).write.parquet(f"{path}/data")
    kind, now = "org.apache.spark.ml.regression.", int(time.time() * 1000)
    about = {"timestamp": now, "sparkVersion": spark.version, "defaultParamMap": {"impurity": "variance"}, "numFeatures": -1}
    tree = about | {"class": f"{kind}DecisionTreeRegressionModel", "paramMap": {"featuresCol": "features", "maxDepth": params.depth}}
    whole = about | {"class": f"{kind}GBTRegressionModel", "paramMap": {"featuresCol": "features", "predictionCol": name}}
    whole |= {"uid": f"GBTRegressor_{uuid.uuid4().hex[:12]}", "numTrees": params.trees}
    weight = F.when(F.col("id") == 0, 1.0).otherwise(float(params.learning_rate))
    each = spark.range(0, params.trees, 1, 1).select(
        F.col("id").cast("int").alias("_1"), F.lit(json.dumps(tree | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"})).alias("_2"), weight.alias("_3")
    )
    each.write.parquet(f"{path}/treesMetadata")
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(whole)).alias("value")).write.text(f"{path}/metadata")
    return GBTRegressionModel.load(path)


def _boost_by_levels(rows: DataFrame, learner: RandomForestRegressor, params: TreeParams, seed: int, name: str) -> GBTRegressionModel:
    """Rows of any number. The sum of the trees so far is stored with them every STORED trees."""
    spark = rows.sparkSession
    rows = workspace.materialize(_dealt(rows.withColumn("_sum", F.lit(0.0))), "boosted")
    trees, stored, weights = [], 0, [1.0] + [params.learning_rate] * (params.trees - 1)
    for number in range(params.trees):
        if number - stored == STORED:
            rows = workspace.materialize(_residuals(rows, trees, weights, stored).drop("_residual"), "boosted")
            stored = number
        left = _residuals(rows, trees, weights, stored)
        if params.row_sample < 1:
            left = left.filter(_drawn(params, F.lit(seed + number)))
        most, n = left.agg(F.max(F.abs("_residual")), F.count(F.lit(1))).first()
        left = left.select("features", _on_grid(F.col("_residual"), _grid(most, n, 2)).alias("_residual"))
        forest = learner.copy({learner.seed: seed + number}).fit(left)
        trees.append(forest._java_obj.trees()[0])
    return _ensemble(spark, trees, weights, name)


def _residuals(rows: DataFrame, trees: list, weights: list[float], stored: int) -> DataFrame:
    """What is left of the label, with the trees that are not in the stored sum; after the first tree the gradient of the squared error."""
    if trees[stored:]:
        rows = _ensemble(rows.sparkSession, trees[stored:], weights[stored : len(trees)], "_more").transform(rows)
        rows = rows.withColumn("_sum", F.col("_sum") + F.col("_more")).drop("_more")
    return rows.withColumn("_residual", (F.col("_label") - F.col("_sum")) * (2.0 if trees else 1.0))


def draw_trials(spark: SparkSession, count: int = TRIAL_COUNT, seed: int = SEED, ranges=TRIAL_RANGES) -> DataFrame:
    """Seeded random parameters, one row per trial; the learning rate is uniform in its log."""

    def uniform(name, offset):
        low, high = ranges[name]
        return F.lit(float(low)) + F.rand(seed + offset) * F.lit(float(high) - float(low))

    def whole(name, offset):
        low, high = ranges[name]
        drawn = F.floor(F.lit(low) + F.rand(seed + offset) * F.lit(high - low + 1))
        return F.least(drawn, F.lit(high)).cast("int")

    low, high = ranges["learning_rate"]
    rate = F.exp(F.log(F.lit(low)) + F.rand(seed + 1) * (F.log(F.lit(high)) - F.log(F.lit(low))))
    return spark.range(0, count, 1, 1).select(
        F.col("id").alias("trial"),
        whole("trees", 0).alias("trees"),
        rate.alias("learning_rate"),
        whole("depth", 2).alias("depth"),
        uniform("row_sample", 3).alias("row_sample"),
        uniform("column_sample", 4).alias("column_sample"),
    )


RESULTS = (
    "horizon int, trial bigint, trees int, learning_rate double, depth int, row_sample double, column_sample double, rmse double"
)


def _errors(vectors: DataFrame, jobs, parallelism: int) -> DataFrame:
    """RESULTS of (horizon, trial, parameters): each is fitted on the train split and scored on the validation split.
    Each fit is a distributed job; `parallelism` of them are under way at a time."""
    train = vectors.filter("split = 'train'")
    validation = vectors.filter("split = 'validation'")

    def one(job):
        horizon, trial, params = job
        scored = fit_trees(train, horizon, params).transform(validation)
        error = regression_metrics(scored, actual=target_name(horizon), predicted=f"tree_{horizon}d").first()
        return (horizon, trial, *asdict(params).values(), error.rmse)

    with ThreadPool(parallelism) as pool:
        rows = pool.map(one, jobs, chunksize=1)
    return vectors.sparkSession.createDataFrame(rows, RESULTS)


def run_trials(vectors: DataFrame, horizons, trials: DataFrame, parallelism: int = PARALLELISM) -> DataFrame:
    """Error of every trial at its full number of trees: one row per (horizon, trial)."""
    jobs = [(h, row.trial, TreeParams(*row[1:])) for row in trials.collect() for h in horizons]
    return _errors(vectors, jobs, parallelism)


def halve_trials(
    vectors: DataFrame, horizons, trials: DataFrame, parallelism: int = PARALLELISM, keep: float = 0.5, first_share: float = 1 / 16
) -> DataFrame:
    """Successive halving (Jamieson & Talwalkar, 2016): one row per (rung, horizon, trial) that was fitted, with the number of
    trees it was fitted with.

    The first rung fits all trials with `first_share` of their trees. Of each horizon the `keep` share with the lowest
    errors goes on, the earlier trial on a tie, NaN last, at least one; the next rung fits these with 1 / keep times as many,
    and the last one, which comes at once when a single trial is left, with all of their trees. A rung's errors are stored before the next one starts, and ranked
    there. A trial that left is a model of fewer trees, so the best row of all rungs is never worse than the best of the first.
    """
    spark = vectors.sparkSession
    if not (0 < keep < 1 and 0 < first_share <= 1):
        raise ValueError("keep lies between 0 and 1, first_share between 0 and 1 or at 1")
    drawn = {row.trial: TreeParams(*row[1:]) for row in trials.collect()}
    wanted = [(h, t) for h in sorted(horizons) for t in sorted(drawn)]
    folder, share, rung = workspace.new_path(spark, "rungs"), first_share, 0
    while True:
        if len(wanted) == len(set(horizons)):
            share = 1.0  # nothing is left to choose among
        jobs = [(h, t, replace(drawn[t], trees=math.ceil(drawn[t].trees * min(share, 1.0)))) for h, t in wanted]
        _errors(vectors, jobs, parallelism).withColumn("rung", F.lit(rung)).write.mode("append").parquet(folder)
        stored = spark.read.parquet(folder)
        if share >= 1:
            return stored
        error = F.when(F.isnan("rmse"), None).otherwise(F.col("rmse"))
        each = Window.partitionBy("horizon")
        ranked = stored.filter(F.col("rung") == rung).withColumns(
            {"_place": F.row_number().over(each.orderBy(error.asc_nulls_last(), "trial")), "_all": F.count(F.lit(1)).over(each)}
        )
        left = ranked.filter(F.col("_place") <= F.greatest(F.lit(1), F.floor(F.col("_all") * keep)))
        wanted = sorted((r.horizon, r.trial) for r in left.select("horizon", "trial").collect())
        share, rung = share / keep, rung + 1


def best_params(results: DataFrame) -> dict[int, TreeParams]:
    """Parameters of the lowest validation error per horizon; equal errors go to the earlier trial, then to fewer trees."""
    valid = results.filter(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    rows = first_per_key(valid, ["horizon"], [F.col("rmse"), F.col("trial"), F.col("trees")]).collect()
    return {
        r.horizon: TreeParams(r.trees, r.learning_rate, r.depth, r.row_sample, r.column_sample)
        for r in rows
    }

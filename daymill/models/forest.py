"""Stored forecasters as rows, so that any number of them is scored in one job.

A saved forecaster keeps, beside its MLlib models, a row per (horizon, tree) with the tree's nodes as arrays, and a row that
tells how feature vectors are made. Vectors are column expressions; trees are walked with numpy, for all rows of a
group and all trees of a model at once. Groups are rows of one (run, horizon), at most about GROUP_ROWS of them.
"""

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.constants import CALENDAR_FEATURES
from daymill.models.trees import LEVEL, NULLABLE

GROUP_ROWS = 4096
TREES = "horizon int, tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
TREE_COLUMNS = [c.split()[0] for c in TREES.split(", ")]


def tree_rows(spark: SparkSession, path: str, horizons) -> DataFrame:
    """TREES of the models saved under `path`/trees. A node's place in the arrays is its id; leaves have no children (-1)
    and hold their value times the weight of their tree."""
    parts = lambda part: spark.read.option("basePath", f"{path}/trees").parquet(
        *[f"{path}/trees/horizon={h}/{part}" for h in horizons]
    )
    n = "nodeData."
    leaf = F.col(n + "leftChild") < 0
    node = F.struct(
        F.col(n + "id").alias("id"),
        F.when(leaf, 0).otherwise(F.col(n + "split.featureIndex")).alias("feature"),
        F.when(leaf, 0.0).otherwise(F.col(n + "split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col(n + "leftChild").alias("left"),
        F.col(n + "rightChild").alias("right"),
        F.when(leaf, F.col(n + "prediction")).otherwise(0.0).alias("value"),
    )
    nodes = parts("data").groupBy("horizon", F.col("treeID").alias("tree")).agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    weights = parts("treesMetadata").toDF("tree", "metadata", "weight", "horizon").drop("metadata")
    weighted = F.transform("nodes.value", lambda v: v * F.col("weight")).alias("value")
    arrays = [F.col(f"nodes.{c}").alias(c) for c in TREE_COLUMNS[2:-1]]
    return nodes.join(weights, ["horizon", "tree"]).select(F.col("horizon").cast("int").alias("horizon"), "tree", *arrays, weighted)


def input_row(spark: SparkSession, inputs: PipelineModel) -> DataFrame:
    """Which nullable features the vector holds, as places in NULLABLE, and what fills each."""
    fills = inputs.stages[1].surrogateDF.first().asDict()
    kept = [i for i, c in enumerate(NULLABLE) if c in fills]
    return spark.createDataFrame([(kept, [float(fills[NULLABLE[i]]) for i in kept])], "kept array<int>, fills array<double>")


def store(spark: SparkSession, path: str, horizons) -> None:
    """Write the rows of a saved forecaster beside its models."""
    tree_rows(spark, path, horizons).write.parquet(f"{path}/forest")
    input_row(spark, PipelineModel.load(f"{path}/inputs")).write.parquet(f"{path}/forest_inputs")


def vector() -> Column:
    """The feature vector, from the features, LEVEL and an input row: filled values, was-null flags, calendar."""
    x = F.array(*[F.col(c).cast("double") for c in NULLABLE])

    def filled(s):
        value = F.get(x, s["kept"])
        return F.when(value.isNull() | F.isnan(value), s["fills"]).otherwise(value)

    return F.concat(
        F.transform(F.arrays_zip("kept", "fills"), filled),
        F.transform("kept", lambda k: F.get(x, k).isNull().cast("double")),
        F.array(*[F.col(c).cast("double") for c in CALENDAR_FEATURES]),
    )


def of_runs(spark: SparkSession, paths, part: str) -> DataFrame:
    """One part of many stored forecasters in one scan, with the `path` of each as it was handed in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    paths = sorted(set(paths))

    def qualified(path):
        place = folder(path)
        return place.getFileSystem(configuration).makeQualified(place).toUri().getPath()

    names = spark.createDataFrame([(qualified(p), p) for p in paths], "_place string, path string")
    # File names come with a scheme and percent signs; a plain path is what both sides share.
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    place = F.regexp_extract(file, r"^(?:[^:/]+:(?://[^/]*)?)?(.*)/" + part + "/[^/]*$", 1)
    return spark.read.parquet(*[f"{p.rstrip('/')}/{part}" for p in paths]).withColumn("_place", place).join(names, "_place").drop("_place")


def _scorer():
    """Nested, so that it travels to the workers by value."""

    def score(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        out = rows.drop(columns=["vector", "_group"])
        if not len(rows) or not len(trees):
            return out.assign(tree=np.nan)
        trees = trees.sort_values("tree")
        x = np.array(rows["vector"].tolist(), dtype=float)
        sizes = trees["left"].map(len).to_numpy()
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        shift = np.repeat(roots, sizes)
        flat = lambda c: np.concatenate(trees[c].to_numpy())
        feature, threshold, value, left, right = map(flat, ("feature", "threshold", "value", "left", "right"))
        leaf = left < 0
        # A leaf leads to itself, so all rows can walk on until the last has arrived.
        own = np.arange(len(leaf))
        left, right = np.where(leaf, own, left + shift), np.where(leaf, own, right + shift)
        at = np.broadcast_to(roots, (len(x), len(roots)))
        lines = np.arange(len(x))[:, None]
        while not leaf[at].all():
            at = np.where(x[lines, feature[at]] <= threshold[at], left[at], right[at])
        return out.assign(tree=value[at].sum(axis=1))

    return score


def score(rows: DataFrame, trees: DataFrame) -> DataFrame:
    """Adds `tree`, the prediction of the ensemble of a row's (path, horizon), to rows with a `vector`; null (NaN) where no
    such ensemble is stored. A run that leads many cities is dealt to as many groups as its rows need, and its trees go
    to each of them."""
    keys = ["path", "horizon"]
    counts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("_groups"))
    dealt = rows.join(counts, keys).withColumn("_group", F.pmod(F.xxhash64("city", "date"), "_groups").cast("int")).drop("_groups")
    models = trees.join(counts, keys).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "vector")
    by = [*keys, "_group"]
    return dealt.groupBy(*by).cogroup(models.groupBy(*by)).applyInPandas(_scorer(), f"{kept}, tree double")

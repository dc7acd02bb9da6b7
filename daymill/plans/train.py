"""A training run: frame, search, fit, test errors, stored forecaster, run log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import workspace
from daymill.constants import HORIZONS, META_END, TRAIN_END, TRIAL_COUNT, VALIDATION_END
from daymill.models.stacked import evaluate, fit_stacked, run_rows
from daymill.models.trees import (
    PARALLELISM,
    SEED,
    best_params,
    city_levels,
    draw_trials,
    fit_inputs,
    halve_trials,
    with_levels,
)
from daymill.plans.training import chrono_split, training_frame
from daymill.sources.sinks import append


def tune(
    frame: DataFrame, horizons=HORIZONS, trials: DataFrame | None = None, parallelism: int = PARALLELISM, search=halve_trials
):
    """Best tree parameters per horizon by validation error. `search` is halve_trials or, to fit every trial with all of its
    trees, run_trials."""
    spark = frame.sparkSession
    trials = draw_trials(spark, TRIAL_COUNT) if trials is None else trials
    levels = workspace.materialize(city_levels(frame.filter("split = 'train'")), "levels")
    levelled = with_levels(frame, levels)
    inputs = fit_inputs(levelled.filter("split = 'train'"))
    used = levelled.filter(F.col("split").isin("train", "validation"))
    vectors = workspace.materialize(inputs.transform(used), "vectors")
    return best_params(search(vectors, horizons, trials, parallelism))


def train(
    spark: SparkSession,
    readings: DataFrame,
    weather: DataFrame,
    models: str,
    runs: str,
    run_order: int,
    trials: DataFrame | None = None,
    ends=(TRAIN_END, VALIDATION_END, META_END),
    horizons=HORIZONS,
    parallelism: int = PARALLELISM,
    seed: int = SEED,
) -> DataFrame:
    """Train one forecaster on the given cities, store it under `models`, append one row per
    (city, horizon) to the run log at `runs`, and return those rows.

    All cities of `readings` share the tree fits. Hand in the readings of one city to give that
    city fits of its own; the champion of each model is chosen over all runs in the log.
    """
    frame = chrono_split(training_frame(readings, weather, horizons), *ends)
    frame = workspace.materialize(frame, "frame")
    params = tune(frame, horizons, trials, parallelism)
    forecaster = fit_stacked(frame, params, seed, parallelism)
    path = f"{models.rstrip('/')}/run={run_order}"
    forecaster.save(path)
    rows = workspace.materialize(run_rows(evaluate(forecaster, frame), params, run_order, path), "runs")
    append(rows, runs)
    return rows

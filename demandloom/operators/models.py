"""Tree models on ``pyspark.ml`` and versioned model folders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators.backtest import assembled
from demandloom.sinks import versions


@dataclass(frozen=True)
class TreeConfig:
    """Fixed training settings of a tree model."""

    name: str
    trees: int
    max_depth: int
    learning_rate: float | None = None
    seed: int = 42
    feature_set: str = S.DEFAULT_FEATURE_SET
    horizon_days: int = 28
    n_windows: int = 5


# Fixed values.  Leaf-wise growth with 64 leaves has no equal in Spark; depth 6
# gives trees of at most 64 leaves.
GRADIENT_BOOSTING = TreeConfig("gradient_boosted_trees", trees=500, max_depth=6, learning_rate=0.05)
GRADIENT_BOOSTING_SHALLOW = TreeConfig(
    "gradient_boosted_trees_shallow", trees=300, max_depth=4, learning_rate=0.05)
RANDOM_FOREST = TreeConfig("random_forest", trees=200, max_depth=10)


def estimator_factory(config: TreeConfig, label: str = "sales") -> Callable[[], Estimator]:
    """A fresh, seeded estimator per call."""

    def gradient_boosting() -> Estimator:
        return GBTRegressor(
            labelCol=label, maxIter=config.trees, maxDepth=config.max_depth,
            stepSize=config.learning_rate, seed=config.seed)

    def random_forest() -> Estimator:
        return RandomForestRegressor(
            labelCol=label, numTrees=config.trees, maxDepth=config.max_depth, seed=config.seed)

    return random_forest if config.learning_rate is None else gradient_boosting


def fit(modeling: DataFrame, config: TreeConfig, label: str = "sales") -> PipelineModel:
    """Fit on all complete cases of the config's feature set."""
    features = S.feature_columns(config.feature_set)
    rows = modeling.select(*features, F.col(label).cast("double").alias(label))
    return assembled(estimator_factory(config, label)(), features).fit(rows)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Importance per feature, largest first (one row per model feature)."""
    tree = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(features, tree.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(
        rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# -- versioned folders ------------------------------------------------------


def model_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Version numbers of a model, ascending; unfinished ones have no number yet."""
    return versions.versions(spark, f"{root}/{name}")


def save_model(model: PipelineModel, root: str, name: str) -> str:
    """Save aside, then publish under the next free number; returns the version.

    Two writers at once get different numbers, and a writer that dies while
    saving leaves no version.
    """
    spark = SparkSession.active()
    folder = f"{root}/{name}"
    staged = versions.staging_path(folder)
    model.save(staged)
    return str(versions.publish_next(spark, staged, folder))


def load_latest_model(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, str]:
    """Highest version by number, not by text; no version is an error."""
    found = model_versions(spark, root, name)
    if not found:
        raise LookupError(f"no version of model {name!r} below {root}")
    return PipelineModel.load(versions.version_path(f"{root}/{name}", found[-1])), str(found[-1])

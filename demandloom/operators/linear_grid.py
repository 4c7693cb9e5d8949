"""Linear models of a whole ablation grid from one aggregation.

A least-squares fit needs only the sums of products of its columns (the Gram
matrix), and those add up: the training rows of window w are the window numbers
above w, the complete cases of a feature set are the missingness patterns without
a gap in it.  So one aggregation by (window number, pattern) serves every set
and window; each fit solves a small matrix of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.splits import BacktestConfig, window_number

GRID = ("feature_set_name string, model_name string, window int, train_rows bigint, test_rows bigint, "
        "wmape double, mae double, rmse double")


def _number(anchor, config: BacktestConfig) -> Column:
    return window_number(F.col(config.date_column), F.lit(anchor), config)


def gram_sums(features: DataFrame, columns: Sequence[str], anchors: Sequence, config: BacktestConfig) -> DataFrame:
    """Sums of products per (window number for each anchor, missingness pattern).

    Every anchor is a newest day that window numbers count back from.  ``pattern``
    has a bit per missing column; missing values count as 0, which no set that
    needs them reads.  The products are the upper triangle over (1, columns,
    target); everything combines map-side to a few dozen rows.
    """
    y = F.col(config.target_column).cast("double")
    x = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns], y]
    gaps = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    numbers = [_number(a, config).alias(f"w{k}") for k, a in enumerate(anchors)]
    rows = features.where(y.isNotNull()).select(
        *numbers, reduce(lambda p, q: p + q, gaps).cast("bigint").alias("pattern"),
        *[v.alias(f"x{i}") for i, v in enumerate(x)])
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}")
                for i in range(len(x)) for j in range(i, len(x))]
    return rows.groupBy(*[f"w{k}" for k in range(len(anchors))], "pattern").agg(
        F.count(F.lit(1)).alias("n"), *products)


def fit_grid(features: DataFrame, feature_sets: Mapping[str, Sequence[str]],
             config: BacktestConfig = BacktestConfig()) -> dict[tuple[str, int], np.ndarray]:
    """Coefficients (intercept first) of every (feature set, window) with training rows.

    A set's windows are anchored to the newest day of its own complete cases.
    Collinear columns get the least-norm solution.
    """
    return {key: cell[0] for key, cell in _cells(features, feature_sets, config).items()}


def _union(feature_sets: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(c for columns in feature_sets.values() for c in columns))


def _anchors(features: DataFrame, feature_sets: Mapping[str, Sequence[str]], config: BacktestConfig) -> dict:
    """Newest complete day of every set that has one."""
    target = F.col(config.target_column).isNotNull()
    newest = [F.max(F.when(reduce(lambda p, q: p & q, [F.col(c).isNotNull() for c in columns], target),
                           F.col(config.date_column))).alias(f"a{i}")
              for i, columns in enumerate(feature_sets.values())]
    row = features.agg(*newest).first()
    return {name: row[i] for i, name in enumerate(feature_sets) if row[i] is not None}


def _cells(features, feature_sets, config):
    """(coefficients, anchor, training rows) per (set, window)."""
    columns = _union(feature_sets)
    width = len(columns) + 2
    newest = _anchors(features, feature_sets, config)
    anchors = sorted(set(newest.values()))
    upper = np.triu_indices(width)
    table = []
    for r in gram_sums(features, columns, anchors, config).collect() if anchors else []:
        gram = np.zeros((width, width))
        gram[upper] = [r[f"g{i}_{j}"] for i, j in zip(*upper)]
        table.append((r, gram + np.triu(gram, 1).T))
    cells = {}
    for name, anchor in newest.items():
        at = [columns.index(c) for c in feature_sets[name]]
        mask = sum(1 << i for i in at)
        use = [0, *[i + 1 for i in at]]
        number = f"w{anchors.index(anchor)}"
        own = [(r, gram) for r, gram in table if not r["pattern"] & mask]
        for window in range(1, config.n_windows + 1):
            train = [(r["n"], gram) for r, gram in own if r[number] > window]
            if not train:
                continue
            gram = sum(g for _, g in train)
            # Columns of very different size: solved on the scale of their own norms.
            scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))[use]
            scaled = gram[np.ix_(use, use)] / np.outer(scale, scale)
            solved = np.linalg.lstsq(scaled, gram[use, -1] / scale, rcond=1e-12)[0] / scale
            cells[(name, window)] = (solved, anchor, sum(n for n, _ in train))
    return cells


def ablation_linear(features: DataFrame, feature_sets: Mapping[str, Sequence[str]],
                    config: BacktestConfig = BacktestConfig(), model_name: str = "linear") -> DataFrame:
    """The grid of linear models: three passes over the features, whatever the number of cells."""
    cells = _cells(features, feature_sets, config)
    y = F.col(config.target_column).cast("double")
    scores = []
    for name, chosen in feature_sets.items():
        fitted = {w: cell for (s, w), cell in cells.items() if s == name}
        if not fitted:
            continue
        newest = next(iter(fitted.values()))[1]
        window = _number(newest, config)
        prediction = F.lit(None).cast("double")
        for w, (coefficients, _, _) in fitted.items():
            line = F.lit(float(coefficients[0]))
            for c, b in zip(chosen, coefficients[1:]):
                line = line + F.lit(float(b)) * F.col(c).cast("double")
            prediction = F.when(window == w, line).otherwise(prediction)
        # Null outside complete cases and windows, as a sum with a null is.
        scores.append(F.struct(F.lit(name).alias("s"), window.alias("w"), prediction.alias("p")))
    if not scores:
        return features.sparkSession.createDataFrame([], GRID)
    rows = features.where(y.isNotNull()).select(y.alias("y"), F.explode(F.array(*scores)).alias("c")).where(
        F.col("c.p").isNotNull())
    error = F.col("c.p") - F.col("y")
    metrics = rows.groupBy("c.s", "c.w").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(error)).alias("a"), F.sum(error * error).alias("q"),
        F.sum("y").alias("y"))
    trained = features.sparkSession.createDataFrame(
        [(s, w, int(cell[2])) for (s, w), cell in cells.items()], "s string, w int, train_rows bigint")
    return metrics.join(trained, ["s", "w"]).select(
        F.col("s").alias("feature_set_name"), F.lit(model_name).alias("model_name"), F.col("w").alias("window"),
        "train_rows", F.col("n").alias("test_rows"),
        F.when(F.col("y") != 0, F.col("a") / F.col("y")).alias("wmape"), (F.col("a") / F.col("n")).alias("mae"),
        F.sqrt(F.col("q") / F.col("n")).alias("rmse"))

"""Tree ensembles as expressions, and leaf-wise boosting, against step-by-step versions."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from demandloom.operators import backtest, boosting, forest, recursion


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(i, float(rng.randrange(12)), rng.choice([None, float("nan"), rng.random() * 9]), float(rng.randrange(3)))
            for i in range(400)]
    data = [(i, a, b, c, a * 2 + (0 if b is None or b != b else b) * c + rng.random()) for i, a, b, c in data]
    return spark.createDataFrame(data, "id long, a double, b double, c double, sales double").repartition(5).cache()


@pytest.mark.parametrize("make", [
    lambda: GBTRegressor(labelCol="sales", maxIter=4, maxDepth=3, seed=1),
    lambda: RandomForestRegressor(labelCol="sales", numTrees=5, seed=1)])
def test_forest_equals_transform(spark, rows, make):
    names = ["a", "b", "c"]
    model = backtest.assembled(make(), names).fit(rows.where("b is not null and not isnan(b)"))
    trees = forest.from_model(model, names)
    assert trees.depth <= 5 and len(trees.roots) == len(model.stages[-1].trees)
    both = model.transform(rows).withColumn("mine", trees.predict({c: F.col(c) for c in names}))
    assert both.agg(F.max(F.abs(F.col("mine") - F.col("prediction")))).first()[0] < 1e-9


def test_recursion_equals_steps(spark):
    rng = random.Random(9)
    history = spark.createDataFrame(
        [("s", f"i{k}", f"2024-0{1 + d // 28}-{d % 28 + 1:02d}", float(rng.randrange(9)), None)
         for k in range(4) for d in range(60 if k else 9)],
        "store_id string, item_id string, date string, sales double, sell_price double")
    names = ["lag_1", "lag_7", "rolling_mean_7", "day_of_week"]
    from demandloom.operators.features import build_features
    model = backtest.assembled(GBTRegressor(labelCol="sales", maxIter=3, maxDepth=3, seed=2), names).fit(
        build_features(history).where("lag_7 is not null"))
    steps = recursion.forecast_model(history, model, names, horizon=9)
    fold = recursion.forecast_expression(history, forest.from_model(model, names).predict, horizon=9)
    key = lambda r: (r.item_id, r.forecast_step)
    a, b = sorted(steps.collect(), key=key), sorted(fold.collect(), key=key)
    assert len(a) == len(b) == 36
    for x, y in zip(a, b):
        assert key(x) == key(y) and x.forecast_date == y.forecast_date and abs(x.prediction - y.prediction) < 1e-9


def grow_by_hand(x, y, edges, trees, leaves, rate, least):
    """Predictions of the same boosting, row by row."""
    bins = np.array([[sum(e < v for e in edges[f]) if v == v else len(edges[f]) for f, v in enumerate(r)] for r in x])
    score = np.full(len(y), y.mean())
    for _ in range(trees):
        g, leaf = score - y, [np.arange(len(y))]

        def best(rows):
            found = (1e-9, None)
            for f in range(bins.shape[1]):
                for b in range(len(edges[f])):
                    low = rows[bins[rows, f] <= b]
                    high = rows[bins[rows, f] > b]
                    if len(low) < least or len(high) < least:
                        continue
                    gain = g[low].sum() ** 2 / len(low) + g[high].sum() ** 2 / len(high) - g[rows].sum() ** 2 / len(rows)
                    if round(gain, 6) > found[0]:
                        found = (round(gain, 6), (low, high))
            return found

        while len(leaf) < leaves:
            found = [best(rows) for rows in leaf]
            k = max(range(len(leaf)), key=lambda i: found[i][0] if found[i][1] else -1)
            if not found[k][1]:
                break
            leaf[k:k + 1] = found[k][1]
        for rows in leaf:
            score[rows] -= rate * g[rows].mean()
    return score


def test_leafwise_equals_brute_force(spark, rows):
    config = boosting.LeafwiseConfig(trees=4, leaves=5, learning_rate=0.3, bins=8, least_rows=10, store_every=2)
    names = ["a", "b", "c"]
    edges = boosting.bin_edges(rows, names, config.bins)
    trees = boosting.fit_leafwise(rows, names, "sales", config)
    assert len(trees.roots) == 4
    got = {r.id: r.p for r in rows.select("id", trees.predict({c: F.col(c) for c in names}).alias("p")).collect()}
    data = sorted(rows.collect())
    x = np.array([[float("nan") if r[c] is None else r[c] for c in names] for r in data])
    want = grow_by_hand(x, np.array([r.sales for r in data]), [edges[f] for f in names], 4, 5, 0.3, 10)
    assert np.abs(np.array([got[r.id] for r in data]) - want).max() < 1e-6


def test_leafwise_edges(spark, rows):
    nothing = boosting.fit_leafwise(rows.limit(0), ["a"], "sales", boosting.LeafwiseConfig(trees=1))
    assert rows.select(nothing.predict({"a": F.col("a")}).alias("p")).distinct().collect()[0].p == 0.0
    same = rows.withColumn("sales", F.lit(2.0))
    flat = boosting.fit_leafwise(same, ["a", "b"], "sales", boosting.LeafwiseConfig(trees=2, leaves=4))
    assert {r.p for r in rows.select(flat.predict({"a": F.col("a"), "b": F.col("b")}).alias("p")).collect()} == {2.0}

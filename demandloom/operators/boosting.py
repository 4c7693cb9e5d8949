"""Leaf-wise gradient boosting on histograms, for squared error.

Features are binned once.  A tree grows best-first: of all leaves the one whose best split gains most is split, until
there are enough leaves.  A split needs one aggregation: the gradient histogram (sum and count for each feature and
bin) of the smaller child; the other child's is the parent's less this one.  An aggregation combines map-side to
features * bins rows per task, so what is shuffled and what reaches the driver do not depend on the number of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.forest import Forest, Node
from demandloom.session import scratch_path
from demandloom.sinks.tables import refresh_path


@dataclass(frozen=True)
class LeafwiseConfig:
    """Fixed training settings; ``bins`` bounds the histograms, ``store_every`` the length of the plan."""

    trees: int = 500
    leaves: int = 64
    learning_rate: float = 0.05
    bins: int = 64
    least_rows: int = 20
    store_every: int = 10


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Up to ``bins`` - 1 upper edges per feature, at its quantiles; one pass over the rows."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None)), shares, 10_000).alias(f)
                       for f in features]).first()
    return {f: sorted(set(found[f] or ())) for f in features}


def binned(value: Column, edges: Sequence[float]) -> Column:
    """How many edges lie below a value; a null or NaN lies above all."""
    known = F.coalesce(value.cast("double"), F.lit(float("nan")))
    return F.size(F.filter(F.lit([float(e) for e in edges]) if edges else F.array().cast("array<double>"),
                           lambda e: e < known))


def best_split(sums: np.ndarray, counts: np.ndarray, least_rows: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of a leaf from its histograms; ties go to the first feature and bin."""
    total, n = sums[0].sum(), counts[0].sum()
    left, below = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(counts, axis=1)[:, :-1]
    above = n - below
    fits = (below >= least_rows) & (above >= least_rows)
    if not fits.any():
        return None
    gain = np.where(fits, left ** 2 / np.maximum(below, 1) + (total - left) ** 2 / np.maximum(above, 1), -np.inf)
    gain -= total ** 2 / n
    feature, at = np.unravel_index(np.round(gain, 6).argmax(), gain.shape)
    return (float(gain[feature, at]), int(feature), int(at)) if gain[feature, at] > 1e-9 else None


def _histogram(rows: DataFrame, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the gradient and counts by feature and bin: features * bins rows at most."""
    sums, counts = np.zeros(shape), np.zeros(shape, np.int64)
    found = rows.select(F.posexplode("bins").alias("feature", "bin"), "gradient").groupBy("feature", "bin").agg(
        F.sum("gradient").alias("s"), F.count(F.lit(1)).alias("n"))
    for r in found.collect():
        sums[r["feature"], r["bin"]], counts[r["feature"], r["bin"]] = r["s"], r["n"]
    return sums, counts


def grow_tree(rows: DataFrame, shape: tuple[int, int], leaves: int, least_rows: int) -> list[dict]:
    """The nodes of one tree over ``rows`` (bins, gradient); a leaf's value is its mean negative gradient."""
    here = F.lit(True)
    sums, counts = _histogram(rows, shape)
    nodes, open_leaves = [], []

    def add(where: Column, sums: np.ndarray, counts: np.ndarray) -> int:
        n = int(counts[0].sum())
        nodes.append({"feature": -1, "bin": 0, "left": -1, "right": -1, "value": -sums[0].sum() / n if n else 0.0})
        split = best_split(sums, counts, least_rows) if n else None
        if split:
            heapq.heappush(open_leaves, (-round(split[0], 6), len(nodes) - 1, split, where, sums, counts))
        return len(nodes) - 1

    add(here, sums, counts)
    for _ in range(leaves - 1):
        if not open_leaves:
            break
        _, node, (_, feature, at), where, sums, counts = heapq.heappop(open_leaves)
        on_left = F.col("bins")[feature] <= at
        left_is_small = 2 * counts[feature, :at + 1].sum() <= counts[feature].sum()
        small = _histogram(rows.where(where & (on_left if left_is_small else ~on_left)), shape)
        rest = (sums - small[0], counts - small[1])
        left, right = (small, rest) if left_is_small else (rest, small)
        nodes[node] |= {"feature": feature, "bin": at, "left": add(where & on_left, *left),
                        "right": add(where & ~on_left, *right)}
    return nodes


def fit_leafwise(rows: DataFrame, features: Sequence[str], label: str, config: LeafwiseConfig = LeafwiseConfig(),
                 edges: Mapping[str, Sequence[float]] | None = None) -> Forest:
    """Boosted trees grown leaf by leaf.  ``edges`` replaces the quantiles of the features.

    The binned rows are stored; the running score of each row is an expression over its bins, stored again every
    ``store_every`` trees.  Rows without a label take no part; without any row every prediction is 0.
    """
    spark, features = rows.sparkSession, list(features)
    rows = rows.where(F.col(label).isNotNull())
    edges = {f: sorted(map(float, edges[f])) for f in features} if edges else bin_edges(rows, features, config.bins)
    shape = (len(features), max(len(e) for e in edges.values()) + 1)
    target = F.col(label).cast("double")
    base = rows.agg(F.avg(target)).first()[0] or 0.0

    def store(frame: DataFrame) -> DataFrame:
        return refresh_path(frame, scratch_path(spark, "binned"))

    data = store(rows.select(F.array(*[binned(F.col(f), edges[f]) for f in features]).alias("bins"), target.alias("y"),
                             F.lit(float(base)).alias("score")))
    nodes, roots, waiting = [], [], []
    by_bin = {str(i): F.col("bins")[i] for i in range(len(features))}
    for tree in range(config.trees):
        score = F.col("score")
        if waiting:
            score = score + _forest_of_bins(waiting, config.learning_rate, len(features)).predict(by_bin)
        scored = data.select("bins", "y", score.alias("score"))
        if len(waiting) == config.store_every:
            data, scored, waiting = (kept := store(scored)), kept, []
        grown = grow_tree(scored.select("bins", (F.col("score") - F.col("y")).alias("gradient")), shape, config.leaves,
                          config.least_rows)
        waiting.append(grown)
        first = len(nodes)
        roots.append(first)
        nodes += [Node(n["feature"], edges[features[n["feature"]]][n["bin"]] if n["feature"] >= 0 else 0.0,
                       first + n["left"], first + n["right"], n["value"]) for n in grown]
    return Forest(tuple(features), tuple(nodes), tuple(roots), (config.learning_rate,) * len(roots), float(base))


def _forest_of_bins(trees: Sequence[list[dict]], weight: float, width: int) -> Forest:
    nodes, roots = [], []
    for grown in trees:
        first = len(nodes)
        roots.append(first)
        nodes += [Node(n["feature"], float(n["bin"]), first + n["left"], first + n["right"], n["value"]) for n in grown]
    return Forest(tuple(map(str, range(width))), tuple(nodes), tuple(roots), (weight,) * len(roots))

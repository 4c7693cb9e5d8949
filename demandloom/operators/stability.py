"""Selection of a model by what its advantage is worth: a Poisson bootstrap over series.

A replicate counts each series Poisson(1) times, by a hash of its keys and the replicate's number, so it is the same on
any partitioning and for all models.  All replicates of all models and windows are one aggregation with map-side
combining; no resampled data exist.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S

REPLICATES, MATERIAL = 40, 0.1
#: Chances that a Poisson(1) number is at most 0, 1, ... 7.
POISSON = tuple(round(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)), 9) for k in range(8))


def times(replicate: Column, keys: Sequence[str] = S.SERIES_KEYS) -> Column:
    """How often a series counts in a replicate: Poisson(1), from the first 32 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws("|", *keys, replicate.cast("string")).cast("binary"))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return sum(F.when(share >= c, 1).otherwise(0) for c in POISSON)


def rank_stable(
    per_series: DataFrame, baselines: Sequence[str], replicates: int = REPLICATES, material: float = MATERIAL,
) -> DataFrame:
    """One row per model of ``per_series`` (model_name, window, series keys, rmsse, weight).

    avg_wrmsse: mean over the windows.  gap: that less the best baseline's (for a baseline: the best other one's).
    gap_low and gap_high: the middle 95 % of the gap over the replicates.  worst_window: the largest relative loss
    against that baseline in a window.  separated: gap_high is below zero.  stable: no window loses ``material`` or more.
    rank: among models that are separated and stable, then the others, by avg_wrmsse.  Series without a value take no part.
    """
    known = per_series.where("rmsse is not null and weight is not null")
    whole = known.select("model_name", "window", "rmsse", "weight", F.lit(-1).alias("b"), F.lit(1).alias("k"))
    drawn = known.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn(
        "k", times(F.col("b"))).where("k > 0").select(*whole.columns)
    sums = whole.unionByName(drawn).groupBy("model_name", "window", "b").agg(
        (F.sum(F.col("k") * F.col("weight") * F.col("rmsse")) / F.nullif(
            F.sum(F.col("k") * F.col("weight")), F.lit(0.0))).alias("wrmsse"))
    # From here on: models * windows * replicates rows.
    means = sums.groupBy("model_name", "b").agg(F.avg("wrmsse").alias("avg"), F.map_from_entries(
        F.collect_list(F.struct("window", "wrmsse"))).alias("windows"))
    rivals = means.where(F.col("model_name").isin(list(baselines))).select(
        F.col("model_name").alias("rival"), F.col("b").alias("of"), F.col("avg").alias("rival_avg"),
        F.col("windows").alias("rival_windows"))
    pairs = means.join(rivals, (F.col("b") == F.col("of")) & (F.col("model_name") != F.col("rival")))
    best = pairs.withColumn(
        "place", F.row_number().over(Window.partitionBy("model_name", "b").orderBy("rival_avg", "rival"))).where("place = 1")
    loss = F.array_max(F.transform(F.map_keys("windows"), lambda w: F.try_element_at("windows", w) / F.try_element_at(
        "rival_windows", w) - 1))
    gap = F.col("avg") - F.col("rival_avg")
    drawn_gap = F.when(F.col("b") >= 0, gap)
    out = best.withColumns({"gap": gap, "loss": loss, "drawn": drawn_gap}).groupBy("model_name").agg(
        F.max(F.when(F.col("b") < 0, F.col("avg"))).alias("avg_wrmsse"),
        F.max(F.when(F.col("b") < 0, F.col("gap"))).alias("gap"),
        F.percentile("drawn", F.lit(0.025)).alias("gap_low"), F.percentile("drawn", F.lit(0.975)).alias("gap_high"),
        F.max(F.when(F.col("b") < 0, F.col("loss"))).alias("worst_window"))
    out = out.withColumns({"separated": F.col("gap_high") < 0, "stable": F.col("worst_window") < material})
    # A few models: one task orders them.
    order = Window.orderBy((~(F.col("separated") & F.col("stable"))).cast("int"), F.round("avg_wrmsse", 9), "model_name")
    return out.withColumn("rank", F.row_number().over(order))

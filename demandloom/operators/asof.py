"""As-of (backward) alignment of low-frequency observations.

Two plans with the same result:

* ``latest_on_each_day`` turns each observation into the days it is valid for
  and equi-joins those with the requested days.  No range predicate, no cross
  join; its intermediate result is as large as its output for a dense spine.
* ``latest_at_or_before`` works for any instant: distinct probe instants and
  observations are merged, and the last observation is carried forward inside
  each key and time slice, then from slice to slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_on_each_day(
    days: DataFrame, observations: DataFrame, feature: str, observed: str, value: str,
    tiebreak: str | None = None, day: str = "date",
) -> DataFrame:
    """(day, feature, source_<observed>, value) for each day and feature.

    Null observations are dropped first, so a missing month takes the month
    before; days before the first observation give no row.
    """
    known = observations.where(F.col(value).isNotNull() & F.col(feature).isNotNull())
    # One row per (feature, day) whatever the number of ingests.
    pick = F.max_by(value, F.struct(*( [tiebreak] if tiebreak else []), value))
    known = known.groupBy(feature, observed).agg(pick.alias(value))

    span = days.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    following = F.lead(observed).over(Window.partitionBy(feature).orderBy(observed))
    valid = (
        known.withColumn("_to", F.coalesce(F.date_sub(following, 1), hi))
        .withColumns({"_from": F.greatest(F.col(observed), lo), "_to": F.least(F.col("_to"), hi)})
        .where(F.col("_from") <= F.col("_to")))
    daily = valid.select(
        feature, F.col(observed).alias(f"source_{observed}"), value,
        F.explode(F.sequence("_from", "_to")).alias(day))
    return daily.join(days.select(day).distinct(), day, "inner").select(
        day, feature, f"source_{observed}", value)


def latest_at_or_before(
    probes: DataFrame, observations: DataFrame, keys: Sequence[str], at: str, observed: str,
    values: Sequence[str], slice_by: str = "month",
) -> DataFrame:
    """Attach the last observation at or before ``at`` to each probe row.

    Distinct (keys, at) instants and observations are cut into time slices, so
    a hot key is spread over as many tasks as it has slices.  A probe takes the
    last observation of its own slice, else the last one of the slices before,
    which is found over one row per key and slice.  Probes without an earlier
    observation keep nulls.
    """
    keys = list(keys)
    payload = F.struct(F.col(observed).alias(observed), *values)
    cut = F.date_trunc(slice_by, F.col("_at").cast("timestamp"))
    instants = probes.select(*keys, F.col(at).alias("_at")).distinct().select(
        *keys, "_at", F.lit(1).alias("_kind"))
    seen = (
        observations.groupBy(*keys, F.col(observed).alias("_at"))
        .agg(F.max(payload).alias("_obs")).withColumn("_kind", F.lit(0)))
    merged = seen.unionByName(instants, allowMissingColumns=True).withColumn("_slice", cut)

    inside = (Window.partitionBy(*keys, "_slice").orderBy("_at", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = (Window.partitionBy(*keys).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    # observation structs start with their instant, so max is the last one
    slices = merged.groupBy(*keys, "_slice").agg(F.max("_obs").alias("_last"))
    carried = slices.select(
        *keys, "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    own = merged.withColumn("_own", F.last("_obs", ignorenulls=True).over(inside))
    answered = own.where("_kind = 1").join(carried, [*keys, "_slice"], "left")
    answer = F.coalesce("_own", "_carried")
    found = answered.select(
        *keys, F.col("_at").alias(at), answer[observed].alias(observed),
        *[answer[v].alias(v) for v in values])
    return probes.join(found, [*keys, at], "left")

"""Exact samples and quantiles by mergeable histograms; nothing sorts its whole input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S

BINS = 1024


def key_hash(keys: Sequence[str]) -> Column:
    """60 bits of the MD5 of the keys joined by ``|``; a null key is empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def sample_n(df: DataFrame, n: int, keys: Sequence[str] = S.GRAIN,
             strata: Sequence[str] = ()) -> DataFrame:
    """The n rows of smallest key hash, of every stratum if any are named.

    All rows if there are fewer.  The choice depends on the keys alone, not on
    partitioning; rows that agree in all keys are told apart by nothing, so keys
    should name a row.  A histogram of logarithmic hash bins tells which bin
    holds the n-th row: bins are fine where hashes are small, so only a little
    more than n rows per stratum are ranked.
    """
    # Doubles keep the order of hashes, and log2 keeps the order of doubles.
    level = F.floor(F.log2(F.col("_hash").cast("double") + 1) * 64).cast("int")
    marked = df.withColumn("_hash", key_hash(keys)).withColumn("_bin", level)
    # Null strata are a stratum: joined on text that tells null from every value.
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in strata]
    marked = marked.withColumn("_stratum", F.array(*cells).cast("array<string>"))
    counts = marked.groupBy("_stratum", "_bin").agg(F.count(F.lit(1)).alias("c"))
    # At most 60 x 64 bins per stratum.
    upto = F.sum("c").over(Window.partitionBy("_stratum").orderBy("_bin"))
    last = counts.select("_stratum", "_bin", (upto - F.col("c")).alias("before")).where(
        F.col("before") < n).groupBy("_stratum").agg(F.max("_bin").alias("_last"))
    near = marked.join(last, "_stratum").where(F.col("_bin") <= F.col("_last"))
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy("_hash", *keys))
    return near.withColumn("_place", place).where(F.col("_place") <= n).select(*df.columns)


def _kth_values(df: DataFrame, ranks: dict[str, list[int]], ends: dict[str, tuple[float, float]],
                ) -> dict[tuple[str, int], float]:
    """Order statistics by 0-based rank of columns whose (least, greatest) are known.

    Every pass counts the values of each open range in equal bins and narrows it
    to the values of the bin that holds the rank, until a range is one value.
    What is shuffled and reaches the driver is ranges x bins, whatever the rows.
    """
    done: dict[tuple[str, int], float] = {}
    # (column, low, high) -> (values below the range, ranks inside)
    open_ranges = {(c, *ends[c]): (0, sorted(set(r))) for c, r in ranks.items() if r}
    while open_ranges:
        todo = {}
        for (c, low, high), (below, inside) in open_ranges.items():
            if low == high:
                done.update({(c, r): low for r in inside})
            else:
                todo[(c, low, high)] = (below, inside)
        if not todo:
            break
        names = list(todo)
        tags = []
        for i, (c, low, high) in enumerate(names):
            x = F.col(c).cast("double")
            # Dividing first keeps the step finite for any two doubles; a difference
            # beyond all doubles falls into the last bin, which keeps the order.
            step = high / BINS - low / BINS
            b = (x - F.lit(low)) / F.lit(step) if step else F.when(x > F.lit(low), F.lit(1.0)).otherwise(F.lit(0.0))
            b = F.floor(F.least(b, F.lit(float(BINS - 1)))).cast("int")
            tags.append(F.when(x.between(F.lit(low), F.lit(high)), F.struct(
                F.lit(i).alias("i"), b.alias("b"), x.alias("x"))))
        bins = df.select(F.explode(F.array_compact(F.array(*tags))).alias("t")).groupBy("t.i", "t.b").agg(
            F.count(F.lit(1)).alias("n"), F.min("t.x").alias("lo"), F.max("t.x").alias("hi"))
        open_ranges = {}
        by_range: dict[int, list] = {}
        for row in bins.collect():
            by_range.setdefault(row["i"], []).append(row)
        for i, name in enumerate(names):
            below, inside = todo[name]
            for row in sorted(by_range[i], key=lambda r: r["b"]):
                hit = [r for r in inside if below <= r < below + row["n"]]
                if hit:
                    open_ranges[(name[0], row["lo"], row["hi"])] = (below, hit)
                below += row["n"]
    return done


def exact_distribution(df: DataFrame, columns: Sequence[str],
                       shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(column, n, avg, std, quantile per share) of numeric columns of any type.

    Nulls and NaN take no part.  Quantiles interpolate between the two nearest
    values.  One pass for moments and bounds, then a few histogram passes over
    all columns and shares together; a column needs no task that holds its
    distinct values.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    row = values.agg(*[e for c in columns for e in (
        F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"std_{c}"),
        F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    ranks, ends = {}, {}
    for c in columns:
        top = row[f"n_{c}"] - 1
        ranks[c] = [r for s in shares for r in (int(s * top), min(int(s * top) + 1, top))] if top >= 0 else []
        ends[c] = (row[f"lo_{c}"], row[f"hi_{c}"])
    found = _kth_values(values, ranks, ends)
    out = []
    for c in columns:
        quantiles = []
        for k, share in enumerate(shares):
            if not ranks[c]:
                quantiles.append(None)
                continue
            low, high = (found[(c, r)] for r in ranks[c][2 * k:2 * k + 2])
            rest = share * (row[f"n_{c}"] - 1) % 1
            quantiles.append(low + (high - low) * rest)
        out.append((c, row[f"n_{c}"], row[f"avg_{c}"], row[f"std_{c}"], *quantiles))
    names = [f"p{round(s * 100)}" for s in shares]
    return df.sparkSession.createDataFrame(
        out, "feature string, n bigint, average double, deviation double, "
             + ", ".join(f"{n} double" for n in names))

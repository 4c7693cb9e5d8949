"""Components of a similarity graph whose candidate pairs share a block, with few comparisons.

Members of a block may be linked; whether a pair is, only a comparison can tell.  Members that are in one component
already need none.  So

1. every member is compared with the least member of one of its blocks, the one it shares most blocks with;
2. in rounds, one member of each component is compared with one of the largest other component of a block, and
   components that turn out linked are merged; blocks that lie in one component are closed;
3. what still crosses components is enumerated block by block, tile by tile: members of the largest component of a
   block meet the others only.  Of these pairs, one for each pair of components is compared at a time, then all that
   are left.  So no pair of different components is left out.

A block that holds a third of all members is dealt out by member for every join and aggregation (partial counts
before the shuffle, tiles of at most ``TILE`` members).  Small blocks are worked on many at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import stage
from demandloom.llm.components import components

#: Rounds of comparisons between representatives at most; a round that links fewer of its pairs ends them, the first
#: one only if it links fewer of those that the probe left, too.
ROUNDS, LEAST_GAIN = 6, 0.05
#: Members of a tile, rows that a task works on together, pairs that it looks at together.
TILE, WORK_ROWS, PAIRS = 1024, 1 << 14, 1 << 18

Verify = Callable[[DataFrame], DataFrame]


def leads(blocks: DataFrame) -> DataFrame:
    """(a, b, n) of the least member a of b's blocks that it shares most blocks with, and how many these are."""
    least = blocks.groupBy("block").agg(F.min("id").alias("a")).select(F.col("block").alias("of"), "a")
    shared = blocks.join(least, F.col("block") == F.col("of")).where("a < id").groupBy(
        F.col("id").alias("b"), "a").agg(F.count(F.lit(1)).alias("n"))
    return shared.groupBy("b").agg(F.max(F.struct("n", F.bitwise_not("a"))).alias("best")).select(
        F.bitwise_not(F.col("best").getField("col2")).alias("a"), "b", F.col("best.n").alias("n"))


def _merged(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """``placed`` with components merged along ``edges`` (pairs of components)."""
    joined = components(edges)
    return placed.join(joined, placed["comp"] == joined["node"], "left").select(
        *[c for c in placed.columns if c != "comp"], F.coalesce("component", "comp").alias("comp"))


def _open(placed: DataFrame, alike: bool) -> DataFrame:
    """Members (block, id, comp, main) of blocks with several components; main is the largest one of the block.

    With ``alike``, of blocks with the same members (told by 128 bits and their number) the least one stands for all.
    """
    marks = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"x{k}") for k in (0, 1)] if alike else []
    sizes = placed.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("m"), *marks)
    several = sizes.groupBy("block").agg(
        F.max(F.struct("m", F.bitwise_not("comp"))).alias("top"), F.count(F.lit(1)).alias("parts"),
        F.sum("m").alias("members"), *[F.bit_xor(f"x{k}").alias(f"x{k}") for k in range(len(marks))]).where("parts > 1")
    if alike:
        several = several.groupBy("members", "x0", "x1").agg(F.min(F.struct("block", "top")).alias("one")).select(
            "one.block", "one.top", "members")
    several = several.select(
        F.col("block").alias("of"), F.bitwise_not(F.col("top").getField("col2")).alias("main"), F.col("top.m").alias("main_members"),
        "members")
    return placed.join(several, F.col("block") == F.col("of")).select(
        "block", "id", "comp", "main", "main_members", "members")


def _representatives(members: DataFrame, salt: int) -> DataFrame:
    """(a, b, ca, cb): a member of each component and one of the main component that it shares most blocks with."""
    one = members.groupBy("block", "comp", "main").agg(
        F.min(F.struct(F.xxhash64("id", F.lit(salt)), F.col("id")))["id"].alias("id"))
    mains = one.where("comp = main").select(F.col("block").alias("of"), F.col("id").alias("a"))
    pairs = one.where("comp != main").join(mains, F.col("block") == F.col("of")).groupBy(
        F.col("main").alias("ca"), F.col("comp").alias("cb")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("a", F.col("id").alias("b"))).alias("pair"))
    best = pairs.groupBy("cb").agg(F.max(F.struct("n", F.bitwise_not("ca"), "pair")).alias("best"))
    return best.select(F.col("best.pair.a").alias("a"), F.col("best.pair.b").alias("b"),
                       F.bitwise_not(F.col("best").getField("col2")).alias("ca"), "cb")


def _tiles(members: DataFrame) -> DataFrame:
    """Members dealt to tasks (block, t0, t1): those of the main component by tiles, the others to all of these
    tiles and to pairs of tiles of their own.  side: 0 and 1 meet each other, 2 meets all."""
    count = lambda n: F.greatest(F.lit(1), F.ceil(n / TILE)).cast("long")
    others = F.col("members") - F.col("main_members")
    placed = members.select(
        "block", "id", "comp", (F.col("comp") == F.col("main")).alias("big"),
        count(F.col("main_members")).alias("big_tiles"), count(others).alias("tiles"), (others == 1).alias("alone"))
    tile = F.pmod(F.xxhash64("id"), F.when(F.col("big"), F.col("big_tiles")).otherwise(F.col("tiles")))
    cell = lambda t0, t1, side: F.struct(t0.cast("long").alias("t0"), t1.cast("long").alias("t1"),
                                         side.cast("int").alias("side"))
    each = lambda n, f: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), f)
    # Tiles of the main component are numbered from -1 downwards.
    meets_main = each(F.col("big_tiles"), lambda k: cell(-1 - k, F.col("tile"), F.lit(1)))
    meets_own = each(F.col("tiles"), lambda k: cell(
        F.least(F.col("tile"), k), F.greatest(F.col("tile"), k),
        F.when(F.col("tile") == k, 2).when(F.col("tile") < k, 0).otherwise(1)))
    of_main = each(F.col("tiles"), lambda k: cell(-1 - F.col("tile"), k, F.lit(0)))
    cells = F.when(F.col("big"), of_main).when(F.col("alone"), meets_main).otherwise(F.concat(meets_main, meets_own))
    return placed.withColumn("tile", tile).select("block", "id", "comp", F.explode(cells).alias("cell")).select(
        "block", "id", "comp", "cell.t0", "cell.t1", "cell.side")


def _least_blocks(members: DataFrame, most: int) -> DataFrame:
    """(id, blocks): the least ``most`` open blocks of every member, in order."""
    return members.groupBy("id").agg(F.slice(F.sort_array(F.collect_list("block")), 1, most).alias("blocks"))


def block_rows(blocks: pa.Array) -> np.ndarray:
    """The ordered blocks of each member as a row of numbers, filled up with the largest one."""
    count = np.diff(blocks.offsets.to_numpy())
    out = np.full((len(blocks), count.max(initial=0)), np.iinfo(np.int64).max)
    out[np.arange(out.shape[1]) < count[:, None]] = blocks.flatten().to_numpy()
    return out


def first_here(block: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether no block before ``block`` is among the least blocks of both members of a pair (rows of ``block_rows``).

    The least block that two members share has none before it, so it keeps the pair.  A pair whose shared blocks
    are among few of the least ones may be kept in several.
    """
    both = np.sort(np.concatenate([left, right], axis=1), axis=1)
    return ~((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < block[:, None])).any(axis=1)


def tile_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A table of tiles, those of one tile together, side 1 before 0; and where each tile starts, with the end."""
    columns = [table.column(c).to_numpy() for c in ("block", "t0", "t1")]
    order = np.lexsort([-table.column("side").to_numpy(), *reversed(columns)])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return table.take(pa.array(order)), np.append(np.flatnonzero(new), len(order))


def crossing_pairs(starts: np.ndarray, side: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one tile whose sides meet and whose components differ; about ``PAIRS`` at a time."""
    rows = np.arange(len(side))
    tile = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ones = np.add.reduceat((side == 1).astype(np.int64), starts[:-1]) if len(side) else rows
    # Side 1 meets what follows it on side 0 or 2, side 2 what follows, side 0 nothing that follows.
    first = np.where(side == 1, (starts[:-1] + ones)[tile], rows + 1)
    count = np.where(side == 0, 0, starts[1:][tile] - first)
    ends = np.cumsum(count)
    at = 0
    while at < len(rows):
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        i = np.repeat(rows[at:last], count[at:last])
        j = np.arange(len(i)) - np.repeat(ends[at:last] - count[at:last] - (ends[at - 1] if at else 0), count[at:last]) + first[i]
        use = comp[i] != comp[j]
        yield i[use], j[use]
        at = last


def found_pairs(found: list[tuple[np.ndarray, ...]], ids: np.ndarray, comp: np.ndarray) -> pa.Table:
    """Rows (i, j, score) as pairs (a, b, ca, cb, score) of ids and components, each once."""
    parts = []
    for i, j, score in found:
        flip = ids[i] > ids[j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        parts.append(np.stack([ids[i], ids[j], np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j]), score]))
    out = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
    order = np.lexsort(out[1::-1])
    out = out[:, order]
    new = np.ones(len(order), bool)
    new[1:] = np.any(out[:2, 1:] != out[:2, :-1], axis=0)
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("a", "b", "ca", "cb", "score"), out[:, new])})


def connect(blocks: DataFrame, verify: Verify, features: DataFrame, tile_pairs: Callable[[pa.Table], pa.Table],
            probe: Verify | None = None, first: Column | None = None, least: int = 0) -> DataFrame:
    """(node, component) of all members with a link to another one.

    ``blocks`` (block, id) are staged rows without repeats.  ``verify`` gives the linked ones of pairs (a, b), with a
    and b.  ``probe`` may drop pairs that cannot be linked; ``first`` is a condition on the n blocks shared with a
    lead.  ``features`` (id and more) are joined to the members that ``tile_pairs`` gets: block, t0, t1, id, comp,
    side and the features, of several tiles; it returns candidate pairs (``found_pairs``) among those that
    ``crossing_pairs`` gives.  No candidate may be left out.  With ``least``, blocks of the same members are one and
    the members have ``blocks``, the least so many they are in, by which ``first_here`` tells repeats of a pair.
    """
    pairs = leads(blocks)
    pairs = (pairs if first is None else pairs.where(first)).select("a", "b")
    edges = stage(verify(stage(probe(pairs) if probe else pairs, "contraction-leads", True)), "contraction-edges", True)
    known = components(edges).select(F.col("node").alias("of_id"), "component")
    placed = blocks.join(known, F.col("id") == F.col("of_id"), "left").select(
        "block", "id", F.coalesce("component", "id").alias("comp"))
    members = stage(_open(placed, least > 0), "contraction-open", True)
    merges = None
    for salt in range(ROUNDS):
        pairs = stage(_representatives(members, salt), "contraction-pairs")
        if salt and not pairs.limit(1).count():
            break
        tried = stage(probe(pairs.select("a", "b")), "contraction-probed") if probe else pairs.select("a", "b")
        linked = _linked_parts(pairs, verify(tried))
        merges = linked if merges is None else merges.unionByName(linked)
        members = stage(_open(_merged(members.select("block", "id", "comp"), linked), least > 0), "contraction-open", True)
        gain = linked.count()
        if gain < LEAST_GAIN * pairs.count() and (salt or gain <= LEAST_GAIN * tried.count()):
            break
    if least:
        features = features.join(_least_blocks(members, least), "id")
    dealt = _tiles(members)
    work = max(1, -(-dealt.count() // WORK_ROWS))
    rest = dealt.withColumn("work", F.pmod(F.xxhash64("block", "t0", "t1"), F.lit(work))).join(features, "id").groupBy(
        "work").applyInArrow(tile_pairs, "a long, b long, ca long, cb long, score long")
    rest = stage(rest.dropDuplicates(["a", "b"]), "contraction-rest", True)
    for last in (False, True):
        tried = rest
        if not last:
            tried = rest.groupBy("ca", "cb").agg(F.max(F.struct("score", "a", "b")).alias("best")).select(
                "best.a", "best.b", "ca", "cb")
        linked = _linked_parts(tried, verify(tried.select("a", "b")))
        merges = linked if merges is None else merges.unionByName(linked)
        if last:
            break
        joined = components(linked)
        part = lambda c, to: joined.select(F.col("node").alias(f"of_{c}"), F.col("component").alias(to))
        rest = stage(rest.join(part("ca", "xa"), F.col("ca") == F.col("of_ca"), "left").join(
            part("cb", "xb"), F.col("cb") == F.col("of_cb"), "left").select(
            "a", "b", F.coalesce("xa", "ca").alias("ca"), F.coalesce("xb", "cb").alias("cb"), "score").where(
            "ca != cb").join(tried.select("a", "b"), ["a", "b"], "left_anti"), "contraction-rest")
    # Components are named by their least members, so links of components are links of members.
    return components(edges.unionByName(merges.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))


def _linked_parts(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """(ca, cb) of the pairs that are linked, staged."""
    hits = linked.select(F.col("a").alias("la"), F.col("b").alias("lb"))
    return stage(pairs.join(hits, (F.col("a") == F.col("la")) & (F.col("b") == F.col("lb"))).select(
        "ca", "cb").distinct(), "contraction-merges").select("ca", "cb", F.col("ca").alias("a"), F.col("cb").alias("b"))

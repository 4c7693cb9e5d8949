"""Merkle manifest of a dataset: a tree per group of rows, and a tree of the groups' roots.

Rows are leaves, ordered by id within their group; every ``FAN`` consecutive nodes become their hash.
All work is by superblocks of ``FAN ** LEVELS`` consecutive nodes, whatever the size of a group:

1. Leaves get their place in the group from a range sort and the sizes of the sorted parts, so no task sees a group.
2. Upwards, each superblock of leaves is reduced by ``LEVELS`` levels to one node; the nodes of the next round are
   dealt to superblocks again, until one is left: three rounds serve 6 * 10**10 leaves.  The groups' roots go the
   same way.
3. Downwards, a superblock of a round needs its outer nodes: for each level above it, the siblings to the left and to
   the right.  They are the same for all its nodes, so they are one row.  Nodes and outer nodes are cogrouped by
   superblock; each node's own siblings are put before the outer ones.
4. The leaves and the outer nodes of their superblocks are cogrouped last: the local levels, the proof and the
   folding of a leaf to a root are done there together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import stage

#: Children of a node, and levels of a superblock (4,096 leaves).
FAN, LEVELS = 16, 3

NODES = "grp string, pos long, n long, node string"
PATHS = "grp string, pos long, lefts array<string>, rights array<string>"
PLACED = "part long, grp string, at long, doc_id long, leaf string, tampered string"
PROVED = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as its byte count, a colon and its text; "-" if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def levels_of(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n = -(-n // FAN)
        levels += 1
    return levels


def reduce_block(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest("".join(out[-1][i:i + FAN])) for i in range(0, len(out[-1]), FAN)])
    return out


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node ``at`` in its run, level by level."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        first = at - at % FAN
        lefts.append("".join(nodes[first:at]))
        rights.append("".join(nodes[at + 1:first + FAN]))
        at //= FAN
    return lefts, rights


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        node = digest(left + node + right)
    return node


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted part with its number and their place among the part's rows of their group."""
    part, last, at = TaskContext.get().partitionId() if TaskContext.get() else 0, None, 0
    for batch in batches:
        places = []
        for group in batch.column(0).to_pylist():
            at = at + 1 if group == last else 0
            last = group
            places.append(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * batch.num_rows, pa.int64()), batch.column(0), pa.array(places, pa.int64()),
             *batch.columns[1:]], ["part", "grp", "at", "doc_id", "leaf", "tampered"])


def placed(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` (grp, doc_id, leaf, tampered, and columns to sort by) with pos and n: place in the group, its size.

    Rows that are equal in all of ``order`` are interchangeable leaves; a number of their own keeps them from
    falling to one part.
    """
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    sorted_rows = spread.repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").select(
        "grp", "doc_id", "leaf", "tampered")
    numbered = stage(sorted_rows.mapInArrow(_number, PLACED), "merkle-leaves")
    sizes = numbered.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("grp")
    before = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", "grp", F.coalesce(before, F.lit(0)).alias("base"), F.sum("size").over(group).alias("n"))
    return numbered.join(bases, ["part", "grp"]).select(
        "grp", (F.col("base") + F.col("at")).alias("pos"), "n", "doc_id", "leaf", "tampered")


def _block(deep: int) -> Column:
    return F.floor(F.col("pos") / FAN ** deep).cast("long").alias("block")


def _reduce(key: tuple, rows: pd.DataFrame, deep: int) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    n = int(rows["n"].iloc[0])
    top = reduce_block(rows["node"].tolist(), min(deep, levels_of(n)))[-1]
    return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // FAN ** deep)], "node": top})


def rounds(nodes: DataFrame, deep: int = LEVELS) -> list[DataFrame]:
    """The nodes of each round (grp, pos, n, node); groups of one node go no further."""
    out = [nodes]
    while out[-1].where("n > 1").limit(1).count():
        out.append(stage(out[-1].where("n > 1").groupBy("grp", _block(deep)).applyInPandas(
            lambda k, rows: _reduce(k, rows, deep), NODES), "merkle-nodes"))
    return out


def _extend(rows: pd.DataFrame, outer: pd.DataFrame, deep: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"grp": [], "pos": [], "lefts": [], "rights": []})
    rows = rows.sort_values("pos")
    levels = reduce_block(rows["node"].tolist(), min(deep, levels_of(int(rows["n"].iloc[0]))))
    above = outer.iloc[0]
    paths = [siblings(levels, i) for i in range(len(rows))]
    return pd.DataFrame({
        "grp": rows["grp"], "pos": rows["pos"], "lefts": [a + list(above["lefts"]) for a, _ in paths],
        "rights": [b + list(above["rights"]) for _, b in paths]})


def _outer(nodes: DataFrame) -> DataFrame:
    """Paths of nodes as the outer ones of their superblocks."""
    rest = [c for c in nodes.columns if c not in ("grp", "pos")]
    return nodes.select(F.concat("grp").alias("of"), (F.col("pos") + 0).alias("block"), *rest)


def paths(levels: list[DataFrame], tops: DataFrame, deep: int = LEVELS) -> DataFrame:
    """Outer siblings of every node of the first of ``levels``; ``tops`` has those of the groups' last nodes."""
    below = None
    for nodes in reversed(levels):
        alone = nodes.where("n = 1").select("grp", "pos").join(tops, "grp").select("grp", "pos", "lefts", "rights")
        if below is not None:
            more = nodes.where("n > 1").groupBy("grp", _block(deep)).cogroup(
                _outer(below).groupBy("of", "block")).applyInPandas(lambda a, b: _extend(a, b, deep), PATHS)
            alone = alone.unionByName(more)
        below = alone
    return below


def _prove(rows: pd.DataFrame, outer: pd.DataFrame, deep: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({c.split()[0]: [] for c in PROVED.split(", ")})
    rows = rows.sort_values("pos")
    leaves = rows["leaf"].tolist()
    levels = reduce_block(leaves, min(deep, levels_of(int(rows["n"].iloc[0]))))
    above = outer.iloc[0]
    proofs, folded = [], []
    for i, changed in enumerate(rows["tampered"]):
        lefts, rights = siblings(levels, i)
        lefts, rights = lefts + list(above["lefts"]), rights + list(above["rights"])
        proofs.append(digest("".join(a + b for a, b in zip(lefts, rights))))
        folded.append(fold(changed or leaves[i], lefts, rights))
    return pd.DataFrame({
        "doc_id": rows["doc_id"].astype("Int64"), "leaf": leaves, "subroot": above["subroot"], "root": above["root"],
        "proof_sha256": proofs, "folded_root": folded, "verified": [f == above["root"] for f in folded]})


def manifest(docs: DataFrame, tampered: Column | None = None, columns: tuple[str, ...] = (
        "doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "source",
        text_col: str = "text", deep: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Rows are hashed over ``columns``; groups are the values of ``group_col``, null before all others, those by
    bytes.  Where ``tampered`` holds, A-Z of the text are lowered before folding, so a proof fails if that changes the
    text.  Null ids come before all ids; rows of one id are ordered by their leaves, and equal rows are leaves of
    their own.  Other columns are ignored.  No rows give no rows.  Superblocks have ``FAN ** deep`` nodes.
    """
    lower = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = [lower if c == text_col else F.col(c) for c in columns]
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        field(group).alias("grp"), group.alias("name"), F.col(id_col).cast("long").alias("doc_id"),
        leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        F.when(tampered if tampered is not None else F.lit(False), leaf_hash(changed)).alias("tampered"))
    leaves = stage(leaves, "merkle-hashed")
    names = leaves.select("grp", "name")
    leaves = stage(placed(leaves, [F.col("name").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf"]),
                   "merkle-placed")
    levels = rounds(leaves.select("grp", "pos", "n", F.col("leaf").alias("node")), deep)
    subroots = levels[0].where("n = 1")
    for nodes in levels[1:]:
        subroots = subroots.unionByName(nodes.where("n = 1"))
    subroots = stage(subroots.select("grp", "node"), "merkle-subroots")

    # The tree of the groups' roots; its only group is "".
    named = subroots.join(names.distinct(), "grp").select(
        F.lit("").alias("grp"), "name", F.lit(None).cast("long").alias("doc_id"), F.col("node").alias("leaf"),
        F.col("grp").alias("tampered"))
    top = stage(placed(named, [F.col("name").asc_nulls_first()]).select(
        "grp", "pos", "n", F.col("leaf").alias("node"), F.col("tampered").alias("of")), "merkle-top")
    top_levels = rounds(top.select("grp", "pos", "n", "node"), deep)
    no_steps = F.array().cast("array<string>")
    root = top_levels[-1].where("n = 1").select("grp", F.col("node").alias("root"))
    top_paths = paths(top_levels, root.select("grp", no_steps.alias("lefts"), no_steps.alias("rights")), deep)
    tops = stage(top.join(top_paths, ["grp", "pos"]).join(root, "grp").select(
        F.col("of").alias("grp"), "lefts", "rights", F.col("node").alias("subroot"), "root"), "merkle-tops")

    # Outer nodes of each superblock of leaves.
    outer = leaves.where("n = 1").select("grp", "pos").join(tops.select("grp", "lefts", "rights"), "grp")
    if len(levels) > 1:
        outer = outer.unionByName(paths(levels[1:], tops.select("grp", "lefts", "rights"), deep))
    outer = _outer(outer.join(tops.select("grp", "subroot", "root"), "grp"))
    return leaves.groupBy("grp", _block(deep)).cogroup(outer.groupBy("of", "block")).applyInPandas(
        lambda a, b: _prove(a, b, deep), PROVED)

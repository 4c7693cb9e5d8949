"""Near duplicates by MinHash with tensored banding, verified on full shingle sets.

A table of a MinHash index has one key per set: ``2 * HALF`` minhashes together.  Made one by one, ``SIDE ** 2``
tables need ``2 * HALF * SIDE ** 2`` minhashes.  Here two small collections of ``SIDE`` half keys (``HALF``
minhashes each) are made, and a table's key combines a half key of the one with a half key of the other: the same
number of tables from ``2 * HALF * SIDE`` minhashes.  Tables share half keys, so they are not independent; a pair of
similarity s is in no common table only if it agrees in no half key of one of the collections, which has a chance of
at most 2 * (1 - s ** HALF) ** SIDE (2.1e-5 for s = 0.85).

Sets that share a table's key are candidates; ``contraction.connect`` compares as few of them as components need, by
their full sets.  Only one text of each distinct set takes part.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import contraction
from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, slices, stage
from demandloom.llm.ngram_join import enough, linked_pairs, points_of, set_points, set_sums, text_sets

#: Minhashes of a half key, half keys of a collection.
HALF, SIDE = 3, 12
#: Rows of keys that a task hands on at a time.
KEY_ROWS = 1 << 16

SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, halves binary, point binary"
_STEPS = np.arange(1, 2 * SIDE * HALF + 1, dtype=np.uint64)
#: An odd multiplier and a mask for each minhash.
_ODD, _MASK = T.mix(_STEPS * T.BASE) | np.uint64(1), T.mix(_STEPS * T.WINDOW_BASE)


def half_keys(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """2 * SIDE half keys per text of the (text, shingle) pairs, ordered by text; zeros where it has none."""
    out = np.zeros((n, 2 * SIDE), np.uint64)
    heads = np.flatnonzero(np.diff(doc, prepend=-1))
    if not len(heads):
        return out
    rows = doc[heads]
    for k in range(2 * SIDE):
        half = np.zeros(len(heads), np.uint64)
        for j in range(k * HALF, (k + 1) * HALF):
            x = (value ^ _MASK[j]) * _ODD[j]
            x ^= x >> np.uint64(29)
            x *= T.WINDOW_BASE
            half = T.mix(half * T.BASE + np.minimum.reduceat(x, heads))
        out[rows, k] = half
    return out


def table_keys(halves: np.ndarray) -> np.ndarray:
    """SIDE * SIDE keys per row of half keys: each of the first collection with each of the second."""
    first, second = halves[:, :SIDE, None], halves[:, None, SIDE:]
    number = np.arange(SIDE * SIDE, dtype=np.uint64).reshape(1, SIDE, SIDE)
    return T.mix(first * T.BASE + T.mix(second + number)).reshape(len(halves), SIDE * SIDE)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n = batch.num_rows
        doc, value = text_sets(batch.column(1), size)
        sums = [set_sums(doc, value, n, salt) for salt in (T.BASE, T.WINDOW_BASE)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_shingles": pa.array(np.bincount(doc, minlength=n), pa.int64()),
            "set_a": pa.array(sums[0].view(np.int64)), "set_b": pa.array(sums[1].view(np.int64)),
            "halves": pa.array([h.tobytes() for h in half_keys(doc, value, n)], pa.binary()),
            "point": set_points(doc, value, n)})


def _halves(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2 * SIDE)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, KEY_ROWS // (SIDE * SIDE)):
            part = batch.slice(first, KEY_ROWS // (SIDE * SIDE))
            keys = table_keys(_halves(part.column(1)))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(keys.ravel().view(np.int64)),
                "id": pa.array(np.repeat(part.column(0).to_numpy(), SIDE * SIDE))})


def _tile_pairs(table: pa.Table, similarity: Fraction) -> pa.Table:
    """Pairs of different components, each in the first of its common tables only.

    What cannot be linked by the sizes of the sets, or by the summed minima of their group counts (a bound of the
    overlap from above), is left out.
    """
    table, starts = contraction.tile_order(table)
    ids, comp, side, n = (table.column(c).to_numpy() for c in ("id", "comp", "side", "n"))
    points = points_of(table.column("point").combine_chunks())
    block, halves = table.column("block").to_numpy().view(np.uint64), _halves(table.column("halves"))
    found = []
    for i, j in contraction.crossing_pairs(starts, side, comp):
        use = enough(np.minimum(n[i], n[j]), n[i], n[j], similarity)
        i, j = i[use], j[use]
        same = halves[i] == halves[j]
        first, second = same[:, :SIDE].argmax(axis=1), same[:, SIDE:].argmax(axis=1)
        number = (first * SIDE + second).astype(np.uint64)
        here = T.mix(halves[i, first] * T.BASE + T.mix(halves[i, SIDE + second] + number)) == block[i]
        i, j = i[here], j[here]
        for k in range(0, len(i), 1 << 14):
            x, y = i[k:k + (1 << 14)], j[k:k + (1 << 14)]
            score = np.minimum(points[x], points[y]).sum(axis=1, dtype=np.int64)
            use = enough(score, n[x], n[y], similarity)
            found.append((x[use], y[use], score[use]))
    return contraction.found_pairs(found, ids, comp)


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float | Fraction = Fraction(85, 100),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: doc_id, n_shingles, component_id, kept.

    Two texts are linked if the Jaccard similarity of their sets of ``size``-word shingles reaches ``similarity``
    (floats are taken at their shortest decimal); every link is confirmed on the full sets.  component_id is the least
    id reachable by links, the text's own included; kept says that it is the text's own.  Null and empty texts have
    an empty set and no link.  Rows of one id are one document, with the links of each of its texts; null ids count as
    the least id.  Extra columns are ignored.  No rows give no rows.
    """
    similarity = Fraction(str(similarity)) if isinstance(similarity, float) else Fraction(similarity)
    no_id = F.lit(-(1 << 63))
    texts = narrow(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", no_id))
    signed = stage(texts.mapInArrow(lambda b: _sign(b, size), SIGNED), "minhash-signed")
    by_set = ["set_a", "set_b", "n_shingles"]
    sets = stage(signed.where("n_shingles > 0").groupBy(*by_set).agg(
        F.min("doc_id").alias("id"), F.first("halves").alias("halves"),
        F.first("point").alias("point")), "minhash-sets")

    keyed = sets.select("id", "halves").mapInArrow(_keys, "block long, id long")
    several = keyed.groupBy("block").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select(
        F.col("block").alias("of"))
    # One id can stand for two sets (rows of one id); it is in a block once.
    blocks = stage(keyed.join(several, F.col("block") == F.col("of"), "left_semi").distinct(), "minhash-blocks", True)
    features = sets.select("id", F.col("n_shingles").alias("n"), "halves", "point")
    linked = contraction.connect(
        blocks, lambda pairs: linked_pairs(pairs, texts, size, similarity), features,
        lambda t: _tile_pairs(t, similarity))

    place = sets.join(linked, F.col("id") == F.col("node"), "left").select(
        *by_set, F.coalesce("component", "id").alias("component_id"))
    out = signed.select("doc_id", *by_set).alias("s").join(place.alias("p"), [
        F.col(f"s.{c}") == F.col(f"p.{c}") for c in by_set], "left").select(
        "doc_id", F.col("s.n_shingles").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.select(F.nullif("doc_id", no_id).alias("doc_id"), "n_shingles",
                      F.nullif("component_id", no_id).alias("component_id"),
                      (F.col("doc_id") == F.col("component_id")).alias("kept"))

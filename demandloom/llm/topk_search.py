"""Exact top-k by inner product, with multi-resolution segment statistics.

A vector is cut into segments; of each the mean m and the deviation s are kept, for
few long segments (coarse) and many short ones (fine).  For vectors q and v with
segments of length l,

    |q - v|**2  >=  sum of l * ((mq - mv)**2 + (sq - sv)**2),

a lower bound of the distance, and with |q|**2 and |v|**2 an upper bound of the
inner product: sum of l * (mq * mv + sq * sv).  Each level discards the vectors whose
bound stays under the k-th best score found so far; survivors get exact scores.

Queries and vectors are packed into blocks in Spark.  Every query block meets
every vector block of its stripe in one task, which carries the k-th best scores
from block to block; the stripes' best are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a stripe, queries of a block, vectors bounded at a time.
STRIPE, QUERY_BLOCK, STEP = 16_384, 1_024, 1_024
#: Segments of each level, coarse to fine.
LEVELS = (4, 16)

_BLOCK = "ids binary, values binary, width int, n int"
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole_vectors(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, values): floor(scale * x) of each component, for vectors without null,
    NaN or infinite components; null vectors and ids are left out."""
    x = F.col(vec_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("values"))


def _pack(table: pa.Table) -> pa.Table:
    """One row of packed ids and values for each width of vectors in a group."""
    ids = table.column("vec_id").to_numpy()
    lists = table.column("values").combine_chunks()
    width = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    start = np.concatenate([[0], np.cumsum(width)])
    out = []
    for w in np.unique(width):
        on = np.flatnonzero(width == w)
        on = on[np.argsort(ids[on], kind="stable")]
        values = flat[start[on][:, None] + np.arange(w)].astype("<i8")
        out.append({"block": table.column("block")[0].as_py(), "ids": ids[on].tobytes(), "values": values.tobytes(),
                    "width": int(w), "n": len(on)})
    return pa.Table.from_pylist(out, pa.schema([
        ("block", pa.int64()), ("ids", pa.binary()), ("values", pa.binary()), ("width", pa.int32()), ("n", pa.int32())]))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, weighted so that the product of two
    rows is an upper bound of the inner product of their vectors."""
    width = x.shape[1]
    cuts = np.linspace(0, width, min(segments, max(width, 1)) + 1).astype(int)
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            piece, root = x[:, a:b], np.sqrt(b - a)
            parts += [piece.mean(axis=1) * root, piece.std(axis=1) * root]
    return np.stack(parts, axis=1) if parts else np.zeros((len(x), 1))


#: Pairs of rows that are gathered at a time.
PAIRS = 1 << 15


def _products(a: np.ndarray, b: np.ndarray, ai: np.ndarray, bi: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows: of all rows if most pairs are asked for, else
    of pairs gathered piece by piece, so that memory stays bounded."""
    if len(ai) * 4 > len(a) * len(b):
        return (a @ b.T)[ai, bi]
    out = np.empty(len(ai), a.dtype)
    for k in range(0, len(ai), PAIRS):
        out[k:k + PAIRS] = np.einsum("ij,ij->i", a[ai[k:k + PAIRS]], b[bi[k:k + PAIRS]])
    return out


def search_block(qids: np.ndarray, q: np.ndarray, vids: np.ndarray, v: np.ndarray, k: int) -> Iterator[tuple]:
    """(query ids, vector ids, scores): each query's k best of the vectors but itself."""
    nq, width = q.shape
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(width, 1)
    levels = [s for s in LEVELS if s <= width] or [1]
    qs = [segment_statistics(q.astype(float), s) for s in levels]
    # Doubles hold all sums exactly below 2**53, and multiply faster.
    whole = np.float64 if top < 2 ** 53 else np.int64
    q = q.astype(whole)
    slack = 1e-9 * (top + 1)
    best = np.full((nq, 0), -np.inf)
    kept: list[tuple[np.ndarray, ...]] = []
    # Vectors of large norm first: the k-th best scores rise early.
    order = np.argsort(-(v.astype(float) ** 2).sum(axis=1), kind="stable")
    for first in range(0, len(v), STEP):
        at = order[first:first + STEP]
        bar = best.min(axis=1) if best.shape[1] == k else np.full(nq, -np.inf)
        some = v[at].astype(float)
        qi, vi = np.nonzero(qs[0] @ segment_statistics(some, levels[0]).T >= (bar - slack)[:, None])
        for stats, segments in zip(qs[1:], levels[1:]):
            keep = _products(stats, segment_statistics(some, segments), qi, vi) >= (bar - slack)[qi]
            qi, vi = qi[keep], vi[keep]
        own = qids[qi] != vids[at[vi]]
        qi, vi = qi[own], vi[own]
        score = _products(q, v[at].astype(whole), qi, vi).astype(np.int64)
        vi = at[vi]
        good = score >= bar[qi]
        kept.append((qi[good], vi[good], score[good]))
        qi, vi, score = (np.concatenate(x) for x in zip(*kept))
        # Each query's k best so far: high scores first, ties to the smaller id.
        rank = np.lexsort((vids[vi], -score, qi))
        qi, vi, score = qi[rank], vi[rank], score[rank]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        on = place < k
        kept = [(qi[on], vi[on], score[on])]
        best = np.full((nq, k), -np.inf)
        best[qi[on], place[on]] = score[on]
    for qi, vi, score in kept:
        yield qids[qi], vids[vi], score


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            read = lambda c, n, w: np.frombuffer(r[c], "<i8").reshape(n, w)
            for a, b, c in search_block(
                    np.frombuffer(r["qids"], np.int64), read("qvalues", r["qn"], r["width"]),
                    np.frombuffer(r["ids"], np.int64), read("values", r["n"], r["width"]), k):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], schema=_HITS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, all if
    there are fewer; ties to the smaller vec_id; a query's own id is no candidate.

    Both inputs have columns vec_id and values (whole numbers), as ``whole_vectors``
    makes them.  Only vectors of the same width are compared.  Rows that repeat a
    vec_id are candidates of their own.  Scores must fit 64 bits.
    """
    n_vectors, n_queries = vectors.count(), queries.count()
    stripes, blocks = max(1, -(-n_vectors // STRIPE)), max(1, -(-n_queries // QUERY_BLOCK))
    packed = lambda df, n: df.withColumn("block", F.pmod(F.xxhash64("vec_id", "values"), F.lit(n))).groupBy(
        "block").applyInArrow(_pack, f"block long, {_BLOCK}")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = packed(queries, blocks).select(
        F.col("block").alias("q_block"), F.col("ids").alias("qids"), F.col("values").alias("qvalues"),
        F.col("n").alias("qn"), "width", each(stripes).alias("stripe"))
    v = packed(vectors, stripes).select(F.col("block").alias("stripe"), "ids", "values", "n", "width",
                                        each(blocks).alias("q_block"))
    hits = q.join(v.hint("shuffle_hash"), ["q_block", "stripe", "width"]).mapInArrow(
        lambda b: _search(b, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

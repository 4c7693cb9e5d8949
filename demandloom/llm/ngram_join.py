"""Exact Jaccard join of shingle sets through an index of group counts.

Every text becomes the set of its distinct word shingles.  The shingles of a set
are hashed into groups; the counts of the groups are a point, and the summed
minima of two points bound the overlap of their sets from above.

Candidates
    A pair of similarity s differs in at most d = (1 - s) / (1 + s) * (|x| + |y|)
    shingles.  Shingles are dealt by hash to d + 1 parts (d for the
    largest set of a size class) and some to spare, so a linked pair has the same
    shingles in several parts.  Sets with the same shingles in a part that is not empty
    form a leaf block of the index; whatever is not in one block cannot be linked
    (``part_keys`` says what becomes of empty parts).  Sets that share no shingle are in no common block, as their
    pairs would grow with the square of their number.  Parts are matched by a 64-bit key.  A task sends one set for each key of a chunk of texts, packed by
    bucket of the key; the other members that the chunk knows go the direct way, so
    a key that a third of all sets have is one entry per chunk.
Within a block
    Each set is compared with one other first: of the least members of its blocks the
    one it shares most blocks with; then representatives of components in rounds
    (``contraction``).  What that leaves in different components goes through an R-tree
    of the block's points: rectangles of similar points, whose summed minima discard
    whole rectangles of pairs, then single pairs.  Blocks with many members are dealt
    out as tiles.  Near copies share many blocks: those of the same members are one, and
    a pair leaves the first of its blocks only.
Verification
    Surviving pairs are compared by their whole texts.

Only one text of each distinct set takes part, so exact copies cost one row.
Pairs already known to be in one component are not compared again: components
need no more, and no link between different components is lost.

Equality of sets and of shingles is judged by 128 and 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import contraction
from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, slices, stage
from demandloom.llm.packing import filled_buckets, pack, unpack

#: Coordinates of a point.
GROUPS = 256
#: Ratio of the bounds of a size class.
CLASS_RATIO = Fraction(13, 10)
#: Points of a rectangle, and of a tile that needs no R-tree.
LEAF, SMALL = 16, 64
#: Blocks of a set that travel with it, to tell pairs that another block has too.
LEAST_BLOCKS = 16

#: Text bytes per chunk that a task works on, and per bucket of part keys.
CHUNK_BYTES, BUCKET_BYTES = 12 << 20, 8 << 20

SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, point binary"
KEYED = "bucket long, keys binary, owners binary, sets binary, n int"
_KEYED = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("owners", pa.binary()), ("sets", pa.binary()),
                    ("n", pa.int32())])


def size_classes(similarity: Fraction, top: int) -> list[tuple[int, int, int, int]]:
    """(least size, largest size, parts, spare parts) of the classes up to size ``top``.

    Of ``parts`` at most parts - spare - 1 can differ between linked sets, so at
    least spare + 1 are alike.
    """
    ratio, share = max(CLASS_RATIO, 1 / similarity), 2 * (1 - similarity) / (1 + similarity)
    out, low = [], 1
    while low <= top / similarity:
        after = max(low + 1, int(low * ratio))
        differ = int(share * (after - 1))
        spare = 3 + differ * 8 // 100
        out.append((low, after - 1, differ + 1 + spare, spare))
        low = after
    return out


def part_keys(doc: np.ndarray, value: np.ndarray, sizes: np.ndarray,
              similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of the parts of every text, in the class of its size and in
    those of larger sets that it could be linked with.

    Empty parts say nothing and are left out.  Linked sets whose parts alike are all
    empty both have more of them than there are spare parts; such sets also give
    their least shingles (``prefix_keys``), so none is missed.
    """
    classes = size_classes(similarity, int(sizes.max(initial=1)))
    low = np.array([c[0] for c in classes])
    parts, spare = (np.array([c[k] for c in classes]) for k in (2, 3))
    own = np.searchsorted(low, sizes, "right") - 1
    docs, keys, step = [], [], 0
    sparse = np.zeros(len(sizes), bool)
    reach = np.array([-(-low_c * similarity.numerator // similarity.denominator) for low_c in low.tolist()])
    while True:
        cls = own + step
        on = (sizes > 0) & (cls < len(classes))
        on &= (step == 0) | (sizes >= reach[np.minimum(cls, len(classes) - 1)])
        if not on.any():
            break
        width = np.where(on, parts[np.minimum(cls, len(classes) - 1)], 0).astype(np.int64)
        first = np.cumsum(width) - width
        use = on[doc]
        d, v = doc[use], value[use]
        part = ((v & np.uint64(0xFFFFFFFF)) * width[d].astype(np.uint64)) >> np.uint64(32)
        sums = np.zeros(int(width.sum()), np.uint64)
        np.add.at(sums, first[d] + part.astype(np.int64), T.mix(v + np.uint64(1)))
        filled = np.zeros(len(sums), bool)
        filled[first[d] + part.astype(np.int64)] = True
        owner = np.repeat(np.arange(len(sizes)), width)
        empty = np.bincount(owner[~filled], minlength=len(sizes))
        sparse |= on & (empty > spare[np.minimum(cls, len(classes) - 1)])
        place = (np.arange(len(sums)) - first[owner]).astype(np.uint64)
        salt = T.mix((np.where(on, cls, 0)[owner].astype(np.uint64) << np.uint64(32)) + place)
        docs.append(owner[filled])
        keys.append(T.mix(sums ^ salt)[filled])
        step += 1
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    use = sparse[doc]
    owner, key = prefix_keys(doc[use], value[use], sizes, similarity)
    docs.append(owner)
    keys.append(key)
    docs, keys = np.concatenate(docs), np.concatenate(keys)
    order = np.argsort(docs, kind="stable")
    return docs[order], keys[order]


def prefix_keys(doc: np.ndarray, value: np.ndarray, sizes: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of the least shingles of every text: so many that at most the others, which are fewer than a
    linked set must share, could all be shared.  Linked sets have one of these in common."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.searchsorted(doc, np.arange(len(sizes)))
    rank = np.arange(len(doc)) - first[doc]
    shared = -(-sizes.astype(np.int64) * similarity.numerator // similarity.denominator)
    use = rank <= (sizes - shared)[doc]
    return doc[use], T.mix(value[use] ^ T.WINDOW_BASE)


def text_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the distinct shingles of lower-cased texts."""
    words = T.scan(texts, lower=True)
    return T.distinct(*T.shingles(words, words.hashes(), size))


def set_sums(doc: np.ndarray, value: np.ndarray, n: int, salt: np.uint64) -> np.ndarray:
    """A hash of each text's set that does not depend on order."""
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, doc, T.mix(value ^ salt))
    return sums


def set_points(doc: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    """How many shingles of each text fall into each of ``GROUPS`` groups; small counts take half a byte or a byte."""
    point = np.bincount(doc * GROUPS + (value >> np.uint64(56)).astype(np.int64), minlength=n * GROUPS).reshape(n, GROUPS)
    most = point.max(axis=1, initial=0)
    halves = (point[:, ::2] | (point[:, 1::2] << 4)).astype("u1")
    return pa.array([halves[i].tobytes() if most[i] < 16 else point[i].astype("u1" if most[i] < 256 else "<u4").tobytes()
                     for i in range(n)], pa.binary())


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n = batch.num_rows
        doc, value = text_sets(batch.column(1), size)
        sizes = np.bincount(doc, minlength=n)
        sums = [set_sums(doc, value, n, salt) for salt in (T.BASE, T.WINDOW_BASE)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_shingles": pa.array(sizes, pa.int64()),
            "set_a": pa.array(sums[0].view(np.int64)), "set_b": pa.array(sums[1].view(np.int64)),
            "point": set_points(doc, value, n)})


def _chunk_keys(batch: pa.RecordBatch, size: int, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, set) pairs of a chunk, ordered by key, then set."""
    keys, sets = [], []
    for part in slices(iter([batch])):
        doc, value = text_sets(part.column(1), size)
        owner, key = part_keys(doc, value, np.bincount(doc, minlength=part.num_rows), similarity)
        keys.append(key)
        sets.append(set_sums(doc, value, part.num_rows, T.BASE)[owner])
    return T.distinct(np.concatenate(keys), np.concatenate(sets))


def _emit_keys(batches: Iterator[pa.RecordBatch], size: int, similarity: Fraction,
               buckets: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    for number, batch in enumerate(slices(batches, CHUNK_BYTES)):
        key, owner = _chunk_keys(batch, size, similarity)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        times = np.diff(np.append(np.flatnonzero(new), len(key)))
        shared = np.repeat(times > 1, times)
        rows = [{"bucket": buckets + (task << 24) + number, "keys": key[shared].tobytes(), "owners": None,
                 "sets": owner[shared].tobytes(), "n": int(shared.sum())}]
        key, owner = key[new], owner[new]
        for b, first, end in filled_buckets(key, buckets):
            sets, at = np.unique(owner[first:end], return_inverse=True)
            kind = np.uint16 if len(sets) <= 1 << 16 else np.uint32
            rows.append({"bucket": b, "keys": pack(key[first:end]), "owners": at.astype(kind).tobytes(),
                         "sets": sets.tobytes(), "n": end - first})
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[i:i + 64], _KEYED)


def _blocks(table: pa.Table) -> pa.Table:
    """(key, set) of the keys that several sets of a bucket have; a chunk's own finds as they are."""
    key, owner = [], []
    for r in table.to_pylist():
        sets = np.frombuffer(r["sets"], np.uint64)
        if r["owners"] is None:
            key.append(np.frombuffer(r["keys"], np.uint64))
            owner.append(sets)
        else:
            kind = np.uint16 if len(r["owners"]) == 2 * r["n"] else np.uint32
            key.append(unpack(r["keys"], r["n"]))
            owner.append(sets[np.frombuffer(r["owners"], kind)])
    key, owner = T.distinct(np.concatenate(key), np.concatenate(owner))
    several = np.zeros(len(key), bool)
    several[1:] |= key[1:] == key[:-1]
    several[:-1] |= key[1:] == key[:-1]
    return pa.table({"block": pa.array(key[several].view(np.int64)), "set": pa.array(owner[several].view(np.int64))})


def enough(overlap: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Whether the overlap reaches the similarity, in whole numbers."""
    return overlap * similarity.denominator >= similarity.numerator * (n_a + n_b - overlap)


def points_of(column: pa.Array) -> np.ndarray:
    """Points as rows of numbers."""
    rows = column.to_pylist()
    size = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), GROUPS), np.int64 if (size > GROUPS).any() else np.uint16)
    for kind, width in (("u1", GROUPS // 2), ("u1", GROUPS), ("<u4", 4 * GROUPS)):
        on = np.flatnonzero(size == width)
        if not len(on):
            continue
        found = np.frombuffer(b"".join(rows[i] for i in on), kind).reshape(len(on), -1)
        if width == GROUPS // 2:
            out[on, ::2], out[on, 1::2] = found & 15, found >> 4
        else:
            out[on] = found
    return out


def _bound(batches: Iterator[pa.RecordBatch], similarity: Fraction) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            overlap = np.minimum(points_of(get("pa")), points_of(get("pb"))).sum(axis=1, dtype=np.int64)
            keep = enough(overlap, get("na").to_numpy(), get("nb").to_numpy(), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verify(batches: Iterator[pa.RecordBatch], size: int, similarity: Fraction) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2 << 20, "ta"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        (da, va), (db, vb) = text_sets(get("ta"), size), text_sets(get("tb").fill_null(""), size)
        n = batch.num_rows
        doc, value = np.concatenate([da, db]), np.concatenate([va, vb])
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        twice = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
        overlap = np.bincount(doc[1:][twice], minlength=n)
        keep = enough(overlap, np.bincount(da, minlength=n), np.bincount(db, minlength=n), similarity)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def rtree_pairs(points: np.ndarray, sizes: np.ndarray, side: np.ndarray,
                similarity: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) that the summed minima cannot exclude.

    The points are packed into rectangles by size and by their widest coordinates.
    ``side`` is 0, 1 or 2 (both): a pair has one point of side 0 or 2 and one of side
    1 or 2.  A rectangle is bounded by its largest coordinates and least size.
    """
    widest = np.argsort(-points.var(axis=0))[:2]
    band = np.argsort(np.argsort(sizes, kind="stable")) // (LEAF * LEAF)
    order = np.lexsort((points[:, widest[1]], points[:, widest[0]] // LEAF, band))
    heads = np.arange(0, len(order), LEAF)
    tops = np.maximum.reduceat(points[order], heads)
    least = np.minimum.reduceat(sizes[order], heads)
    for k, head in enumerate(heads):
        mine = order[head:head + LEAF]
        near = np.flatnonzero(enough(np.minimum(tops[k], tops[k:]).sum(axis=1, dtype=np.int64), least[k], least[k:], similarity)) + k
        if not len(near):
            continue
        other = np.concatenate([order[heads[x]:heads[x] + LEAF] for x in near])
        i, j = np.repeat(mine, len(other)), np.tile(other, len(mine))
        use = (((side[i] != 1) & (side[j] != 0)) | ((side[i] != 0) & (side[j] != 1))) & (i != j)
        i, j = i[use], j[use]
        keep = enough(np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64), sizes[i], sizes[j], similarity)
        yield i[keep], j[keep]


def _tile_pairs(table: pa.Table, similarity: Fraction) -> pa.Table:
    """Pairs of different components that the points of their tile allow, with the bound of their overlap; a pair leaves
    the least block that its sets share (``contraction.first_here``).

    Tiles of a few rectangles are compared point by point, larger ones through the R-tree.
    """
    table, starts = contraction.tile_order(table)
    ids, comp, side, n = (table.column(c).to_numpy() for c in ("id", "comp", "side", "n"))
    points = points_of(table.column("point").combine_chunks())
    block, blocks = table.column("block").to_numpy(), contraction.block_rows(table.column("blocks").combine_chunks())
    found = []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        use = enough(np.minimum(n[i], n[j]), n[i], n[j], similarity) & (comp[i] != comp[j])
        i, j = i[use], j[use]
        score = np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64)
        use = enough(score, n[i], n[j], similarity)
        i, j, score = i[use], j[use], score[use]
        use = contraction.first_here(block[i], blocks[i], blocks[j])
        found.append((i[use], j[use], score[use]))

    large = np.diff(starts) > SMALL
    for t in np.flatnonzero(large):
        part = slice(starts[t], starts[t + 1])
        for i, j in rtree_pairs(points[part], n[part], side[part], similarity):
            keep(starts[t] + i, starts[t] + j)
    if large.any():
        rows = np.flatnonzero(~np.repeat(large, np.diff(starts)))
        starts = np.append(0, np.cumsum(np.diff(starts)[~large]))
    else:
        rows = np.arange(len(ids))
    if len(rows):
        for i, j in contraction.crossing_pairs(starts, side[rows], comp[rows]):
            for k in range(0, len(i), 1 << 14):
                keep(rows[i[k:k + (1 << 14)]], rows[j[k:k + (1 << 14)]])
    return contraction.found_pairs(found, ids, comp)


def linked_pairs(pairs: DataFrame, texts: DataFrame, size: int, similarity: Fraction) -> DataFrame:
    """Of candidate pairs (a, b): the linked ones."""
    pairs = stage(pairs, "ngram-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    used = stage(texts.join(ids.hint("merge"), texts["doc_id"] == ids["id"]).select("id", "text"), "ngram-texts")
    left = used.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = used.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    # The text of b first: of the pairs with a lead each has its own b, so each text is moved once.
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return both.mapInArrow(lambda x: _verify(x, size, similarity), "a long, b long")


def similar_groups(docs: DataFrame, size: int = 5, similarity: float | Fraction = Fraction(8, 10),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: doc_id, n_shingles, component_id.

    Two texts are linked if the Jaccard similarity of their shingle sets reaches
    ``similarity`` (as a fraction; floats are taken at their shortest decimal).
    component_id is the least id reachable by links, the text's own included.  Null
    and empty texts have an empty set and no link.  Ids are expected to be unique;
    rows of one id and different texts are judged one by one, each with its own set.
    Null ids count as the least id.  Extra columns are ignored.
    """
    similarity = Fraction(str(similarity)) if isinstance(similarity, float) else Fraction(similarity)
    no_id = F.lit(-(1 << 63))
    texts = narrow(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", no_id))
    signed = stage(texts.mapInArrow(lambda b: _sign(b, size), SIGNED), "ngram-signed")
    by_set = ["set_a", "set_b", "n_shingles"]
    sets = stage(signed.where("n_shingles > 0").groupBy(*by_set).agg(
        F.min("doc_id").alias("id"), F.first("point").alias("point")), "ngram-sets")

    # Leaf blocks: sets with the same counts in a part.
    amount = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-amount // BUCKET_BYTES))
    found = texts.mapInArrow(lambda b: _emit_keys(b, size, similarity, buckets), KEYED).groupBy(
        "bucket").applyInArrow(_blocks, "block long, set long")
    in_blocks = stage(found.join(sets.select("set_a", "id"), F.col("set") == F.col("set_a")).select(
        "block", "id").distinct(), "ngram-in-blocks", True)
    points = sets.select("id", F.col("n_shingles").alias("n"), "point")
    side = lambda x: points.select(
        F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("point").alias(f"p{x}"))
    linked = contraction.connect(
        in_blocks, lambda pairs: linked_pairs(pairs, texts, size, similarity), points,
        lambda t: _tile_pairs(t, similarity),
        probe=lambda pairs: pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(
            lambda b: _bound(b, similarity), "a long, b long"),
        least=LEAST_BLOCKS)

    place = sets.join(linked, F.col("id") == F.col("node"), "left").select(
        *by_set, F.coalesce("component", "id").alias("component_id"))
    out = signed.select("doc_id", *by_set).alias("s").join(place.alias("p"), [
        F.col(f"s.{c}") == F.col(f"p.{c}") for c in by_set], "left")
    return out.select(
        F.nullif("doc_id", no_id).alias("doc_id"), F.col("s.n_shingles").alias("n_shingles"),
        F.nullif(F.coalesce("component_id", "doc_id"), no_id).alias("component_id"))

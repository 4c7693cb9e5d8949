"""Benchmark passages inside texts: CGK embedding, bit-sampling LSH, edit distance.

Texts and items are sequences of plain words (runs of ASCII letters, digits and
other characters beyond ASCII; A-Z in lower case; each character of scripts without
spaces is a word).  An item of m words occurs in a text if some passage of it is
within ``(1 - similarity) * m`` word edits.

1. A passage within k edits shares at least m - q + 1 - k * q runs of q words with
   its item, all within m + k words.  Places of a text that have fewer runs in common
   with an item are left out, which loses nothing; q is 3, or less for items that
   would not have to share a run of 3.
2. The item-sized windows of a place are embedded by CGK walks: at each step a walk
   copies the current word and moves on if a hash of step and word says so.  After an
   edit two walks soon meet again, so edit distance becomes Hamming distance.  A table
   of a bit-sampling LSH compares a few sampled steps; a place is a candidate if one of
   its windows agrees with the item in a table.  Each table has a walk of its own.
3. Candidates are verified by the exact edit distance of the item to the best passage
   of the place.

How many tables an item needs depends on its length: the number is the least that
finds ``recall`` of edited copies of the block's items of about that length, with as
many random edits as are allowed (measured with all tables together, so nothing is
assumed about their independence; by default all of the measured copies).  For lengths where ``MOST_TABLES`` do not reach
it, all places are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import free_name, narrow, row_key, slices

#: Bytes of items in one pass; more items make more passes over the texts.
BLOCK_BYTES = 16 << 20
#: Words of a run at most, sampled steps of a table, most tables.
RUN, SAMPLED, MOST_TABLES = 3, (2, 1), 32
#: Edited copies that the number of tables is measured on, for each length class.
COPIES = 2048
#: Windows embedded at a time.
WINDOWS = 1 << 13

PAIRS = "doc_id long, item_id long, first_word int, edits int"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int32()),
                    ("edits", pa.int32())])


def cgk(seqs: np.ndarray, walk: int) -> np.ndarray:
    """The CGK embedding of each row of words: three times as many steps, 0 past the end."""
    n, m = seqs.shape
    padded = np.concatenate([seqs, np.zeros((n, 1), np.uint64)], axis=1)
    at, rows = np.zeros(n, np.int64), np.arange(n)
    out = np.empty((n, 3 * m), np.uint64)
    for step in range(3 * m):
        word = padded[rows, at]
        out[:, step] = word
        move = T.mix(word ^ np.uint64((walk * 0x9E3779B1 + step * 0x85EBCA77 + 1) & (2**64 - 1))) >> np.uint64(63)
        at = np.minimum(at + move.astype(np.int64), m)
    return out


def sampled_steps(m: int, table: int, sampled: int) -> np.ndarray:
    """Steps of the walk that a table looks at: early ones, as late ones may be past the end."""
    return np.sort(np.random.default_rng(table * 1009 + m).choice(max(2 * m - 2, sampled), sampled, replace=False))


def table_keys(seqs: np.ndarray, sampled: int, tables: int) -> np.ndarray:
    """Keys of all sequences in all tables: one row per table."""
    n, m = seqs.shape
    out = np.zeros((tables, n), np.uint64)
    for t in range(tables):
        for column in cgk(seqs, t)[:, sampled_steps(m, t, sampled)].T:
            out[t] = T.mix(out[t] * T.BASE + column)
    return out


def edited(item: np.ndarray, edits: int, copies: int, rng: np.random.Generator) -> np.ndarray:
    """Copies of an item with random edits; each keeps the item's length, as a window does."""
    m, out = len(item), []
    for _ in range(copies):
        c = item.tolist()
        for _ in range(edits):
            i, kind = int(rng.integers(len(c))), rng.integers(3)
            c[i:i + (kind != 2)] = [] if kind == 1 and len(c) > 1 else [int(rng.integers(1, 1 << 62))]
        out.append((c + rng.integers(1, 1 << 62, m).tolist())[:m])
    return np.array(out, np.uint64)


def tables_needed(items: list[np.ndarray], similarity: float, recall: float) -> tuple[int, int]:
    """(sampled steps, tables): the fewest that find the share ``recall`` of edited copies of items of one length; no
    tables if ``MOST_TABLES`` are not enough."""
    rng, m = np.random.default_rng(len(items[0])), len(items[0])
    if not allowed(m, similarity):
        return SAMPLED[0], 1
    each = -(-COPIES // len(items))
    copies = np.concatenate([edited(x, allowed(m, similarity), each, rng) for x in items])
    for sampled in SAMPLED:
        wanted = np.repeat(table_keys(np.stack(items), sampled, MOST_TABLES), each, axis=1)
        found = np.logical_or.accumulate(table_keys(copies, sampled, MOST_TABLES) == wanted, axis=0).mean(axis=1)
        if found[-1] >= recall:
            return sampled, int(np.argmax(found >= recall)) + 1
    return SAMPLED[0], 0


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the passage of ``text`` nearest to ``item``, by Sellers' recurrence."""
    row = np.zeros(len(text) + 1, np.int64)
    ramp = np.arange(len(text) + 1)
    for i, word in enumerate(item, 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp
    return int(row.min()), int(row.argmin())


def allowed(m: int, similarity: float) -> int:
    """Word edits allowed on an item of m words."""
    return int(m * (1 - similarity) + 1e-9)


@dataclass
class Index:
    """What a task needs of a block of items: bounded by the block's size."""

    ids: np.ndarray
    words: list[np.ndarray]
    runs: np.ndarray  # distinct runs of all items, sorted
    first: np.ndarray  # owners[first[r]:first[r + 1]] are the items with run r
    owners: np.ndarray
    least: np.ndarray  # runs that a passage shares with each item at least
    similarity: float
    run: int  # words of a run
    tables: dict[int, tuple[int, int]]  # (sampled steps, tables) by words of an item; no table: every place is verified
    keys: list[np.ndarray]  # of each item, in the tables of its length


def build_indexes(rows: list[tuple[int, str]], similarity: float, recall: float, min_words: int) -> list[Index]:
    """One index for each length of runs that the items need."""
    texts = pa.array([t for _, t in rows], pa.string())
    w = T.scan(texts, lower=True, solid=T.PLAIN, single=True)
    h = w.hashes()
    words = [h[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
    size = np.array([len(x) for x in words], np.int64)
    edits = np.array([allowed(m, similarity) for m in size], np.int64)
    run = np.select([size - q + 1 - edits * q >= 1 for q in range(RUN, 1, -1)], range(RUN, 1, -1), 1)
    by_class: dict[int, list[int]] = {}
    for i in np.flatnonzero(size >= max(1, min_words)):
        by_class.setdefault(int(size[i]), []).append(int(i))
    tables, measured = {}, {}
    for m, members in by_class.items():
        # Lengths of one class (within about a tenth) share the measurement on the class's first length.
        level = (int(10 * np.log(m + 1)), allowed(m, similarity) > 0)
        if level not in measured:
            some = np.random.default_rng(m).permutation(members)[:256]
            measured[level] = tables_needed([words[i] for i in some], similarity, recall)
        tables[m] = measured[level]
    keys: dict[int, np.ndarray] = {}
    for m, members in by_class.items():
        found = table_keys(np.stack([words[i] for i in members]), *tables[m]).T
        keys |= dict(zip(members, found))
    out = []
    for q in np.unique(run):
        mine = [i for i in range(len(words)) if run[i] == q and i in keys]
        if not mine:
            continue
        own = [words[i] for i in mine]
        m, k = size[mine], edits[mine]
        owner, value = T.distinct(np.repeat(np.arange(len(own)), np.maximum(m - q + 1, 0)),
                                  np.concatenate([np.zeros(0, np.uint64), *(_runs(x, q) for x in own)]))
        order = np.argsort(value, kind="stable")
        runs, first = np.unique(value[order], return_index=True)
        out.append(Index(np.array([rows[i][0] for i in mine], np.int64), own, runs, np.append(first, len(value)),
                         owner[order], np.maximum(1, m - q + 1 - k * q), similarity, int(q), tables,
                         [keys[i] for i in mine]))
    return out


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    if len(words) < size:
        return np.zeros(0, np.uint64)
    value = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        value = value * T.WINDOW_BASE + words[k:len(words) - size + 1 + k]
    return T.mix(value)


def _lookup(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each value among the sorted wanted ones, or -1."""
    out = np.full(len(values), -1, np.int64)
    if len(wanted) and len(values):
        sieve = np.zeros(1 << 16, bool)
        sieve[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(sieve[(values & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(wanted, values[maybe]), len(wanted) - 1)
        hit = wanted[at] == values[maybe]
        out[maybe[hit]] = at[hit]
    return out


def places(runs: np.ndarray, index: Index) -> list[tuple[int, int, int]]:
    """(item, start, end): the parts of a text that have enough runs of an item, those that overlap joined.

    ``runs[i]`` is the number of the known run at word i of a text, or -1.
    """
    at = np.flatnonzero(runs >= 0)
    count = np.diff(index.first)[runs[at]]
    place = np.repeat(at, count)
    offset = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    item = index.owners[np.repeat(index.first[runs[at]], count) + offset]
    some = np.bincount(item, minlength=len(index.words)) >= index.least
    item, place = item[some[item]], place[some[item]]
    order = np.argsort(item, kind="stable")
    item, place = item[order], place[order]
    out = []
    for mine in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1) if len(item) else ():
        i, here = int(item[mine[0]]), place[mine]
        m, least = len(index.words[i]), int(index.least[i])
        k = allowed(m, index.similarity)
        first, last = here[:len(here) - least + 1], here[least - 1:]
        # A passage of up to m + k words that holds all runs from first to last.
        near = last - first + index.run <= m + k
        low, high = np.maximum(last[near] + index.run - (m + k), 0), first[near] + m + k
        if len(low):
            new = np.append(True, low[1:] > high[:-1])
            out += [(i, int(a), int(b)) for a, b in zip(low[new], high[np.append(new[1:], True)])]
    return out


def agreeing(found: list[tuple[int, int, int, int]], words: np.ndarray, index: Index) -> np.ndarray:
    """Which places (text, item, start, end; in words of the slice) have a window that agrees with their item in a table."""
    out = np.zeros(len(found), bool)
    by_size: dict[int, list[int]] = {}
    for p, (_, item, _, _) in enumerate(found):
        by_size.setdefault(len(index.words[item]), []).append(p)
    padded = np.concatenate([words, np.zeros(max(by_size, default=0), np.uint64)])
    for m, mine in by_size.items():
        if not index.tables[m][1]:
            out[mine] = True
            continue
        starts = [np.arange(found[p][2], max(found[p][2], found[p][3] - m) + 1) for p in mine]
        place = np.repeat(mine, [len(x) for x in starts])
        at = np.concatenate(starts)
        for piece in range(0, len(at), WINDOWS):
            some, of = at[piece:piece + WINDOWS], place[piece:piece + WINDOWS]
            wanted = np.stack([index.keys[found[p][1]] for p in of], axis=1)
            hit = (table_keys(padded[some[:, None] + np.arange(m)], *index.tables[m]) == wanted).any(axis=0)
            out[of[hit]] = True
    return out


def _search(batches: Iterator[pa.RecordBatch], indexes: list[Index]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids = batch.column(0).to_pylist()
        w = T.scan(batch.column(1), lower=True, solid=T.PLAIN, single=True)
        h = w.hashes()
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for index in indexes:
            runs = np.full(len(h), -1, np.int64)
            runs[:max(len(h) - index.run + 1, 0)] = _lookup(_runs(h, index.run), index.runs)
            for k in range(1, index.run):  # runs across two texts are none
                ends = w.first[1:] - k
                runs[ends[ends >= w.first[:-1]]] = -1
            known = np.concatenate([[0], np.cumsum(runs >= 0)])
            found = []
            for d in np.flatnonzero(known[w.first[1:]] - known[w.first[:-1]] >= index.least.min(initial=1 << 30)):
                a, b = int(w.first[d]), int(w.first[d + 1])
                found += [(int(d), item, a + low, min(a + high, b)) for item, low, high in places(runs[a:b], index)]
            for (d, item, low, high), agrees in zip(found, agreeing(found, h, index)):
                if not agrees:
                    continue
                m = len(index.words[item])
                edits, end = best_passage(index.words[item], h[low:high])
                key = (d, int(index.ids[item]))
                if edits <= allowed(m, index.similarity) and (key not in best or edits < best[key][1]):
                    best[key] = (max(0, low - int(w.first[d]) + end - m), edits)
        out = [{"doc_id": ids[d], "item_id": item, "first_word": first, "edits": edits}
               for (d, item), (first, edits) in sorted(best.items())]
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW)


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = 0.8, recall: float = 1.0,
                 min_words: int = 1, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, edits): which items occur in which texts.

    One row per text and item, with the best passage found.  Null and empty texts
    hold nothing; null items, items without a plain word and those of fewer than
    ``min_words`` (none by default; short items have to occur word by word) take no
    part.  Equal items are all reported, those of one id by the best one.  Items go
    to the tasks in blocks of at most ``BLOCK_BYTES``, each a pass over the texts.
    """
    spark = docs.sparkSession
    bench = items.select(F.col(item_id_col).cast("long").alias("doc_id"),
                         F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_BYTES))
    texts, out = narrow(docs, id_col, text_col), None
    for b in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == b).collect()
        index = spark.sparkContext.broadcast(build_indexes(
            sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in rows), similarity, recall, min_words))
        part = texts.mapInArrow(lambda x, i=index: _search(x, i.value), PAIRS)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the texts that hold an item; columns as they are.

    Every row is judged by its own text: rows of one id and rows without an id do not
    share a verdict.
    """
    key = row_key([options.pop("id_col", "doc_id"), options.get("text_col", "text")])
    mine = free_name(docs.columns, "row_key")
    theirs = free_name([*docs.columns, mine], "found_key")
    keyed = docs.withColumn(mine, key)
    found = contaminated(keyed, items, id_col=mine, **options).select(F.col("doc_id").alias(theirs)).distinct()
    return keyed.join(found, F.col(mine) == F.col(theirs), "left_anti").drop(mine)

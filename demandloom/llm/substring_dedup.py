"""Removal of repeated passages: Rabin-Karp hashes of every window of words.

Every window of ``window`` consecutive words of every text is hashed with a
rolling 64-bit value.  A window is repeated if the same value starts in a text
with a smaller id; all words under repeated windows go, so overlapping windows
merge into maximal removal intervals.

How the windows are counted
    A task hashes about 12 MB of whole texts (a chunk).  Within the chunk only
    the windows of the smallest id stand for their value; the others are known to
    be repeated at once.  So a passage that a third of all texts share leaves a
    chunk as one entry.  Entries travel to buckets of the value, packed: sorted
    values as 48-bit differences, the window's number within the chunk, and the
    ids of the chunk's texts.  A bucket finds the smallest id of each value over
    all chunks and returns the numbers of the repeated windows to their chunk,
    where they become intervals.  The number of buckets follows the size of the
    input, so a bucket holds about a million windows.

Exactness
    Equal sequences always have equal values.  Different ones have equal values
    with a chance of about 2**-64 per pair of windows, as far as the mixed 64-bit
    values of words can be taken as random (for 10**9 windows, one wrong window is
    expected in 37 such corpora); windows of two alternating words in a Thue-Morse
    pattern lose up to 20 of these bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, row_key, slices, stage
from demandloom.llm.packing import filled_buckets, pack, unpack

CHUNK_BYTES = 12 << 20
#: Text bytes per bucket of values; about a million windows of usual words.
BUCKET_BYTES = 8 << 20

PACKED = ("bucket long, chunk long, hashes binary, windows binary, ids binary, marks binary, ends binary, n int")
SPANS = "doc_id long, mark long, starts array<int>, ends array<int>"

_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()),
                    ("windows", pa.binary()), ("ids", pa.binary()),
                    ("marks", pa.binary()), ("ends", pa.binary()),
                    ("n", pa.int32())])


def window_hashes(words: T.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of a slice, text after text, and their number per text."""
    runs = np.maximum(words.counts - window + 1, 0)
    sums = T.prefix_sums(words.hashes(), T.WINDOW_BASE)
    at = np.repeat(words.first[:-1] - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
    _, down = T.powers(T.WINDOW_BASE, max(len(words.start), 1))
    return T.mix((sums[at + window] - sums[at]) * down[at]), runs


def _chunk_rows(batch: pa.RecordBatch, chunk: int, window: int, buckets: int) -> Iterator[dict]:
    ids, marks = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 2))
    parts, runs = [], []
    for part in slices(iter([batch])):  # numpy work in pieces that fit the processor's cache
        h, n = window_hashes(T.scan(part.column(1)), window)
        parts.append(h)
        runs.append(n)
    value, run = np.concatenate(parts), np.concatenate(runs)
    if not len(value):
        return
    doc = np.repeat(np.arange(len(ids)), run)
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    order = np.lexsort((rank[doc], value))
    value, at = value[order], order
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    owner = ids[doc[at]]
    least = owner[np.flatnonzero(new)][np.cumsum(new) - 1]
    local = np.sort(at[owner > least])
    end = np.cumsum(run)
    used = run > 0
    # The chunk's own row: its texts and the windows already known to be repeated.
    yield {"bucket": buckets + chunk, "chunk": chunk, "hashes": None,
           "windows": local.astype(np.uint32).tobytes(), "ids": ids[used].tobytes(), "marks": marks[used].tobytes(),
           "ends": end[used].astype(np.uint32).tobytes(), "n": len(local)}
    # Of the others only the smallest id's windows travel: all of them, as a text may
    # hold one several times.
    value, at = value[owner == least], at[owner == least]
    for b, first, last in filled_buckets(value, buckets):
        v, w = value[first:last], at[first:last]
        present = np.unique(doc[w])
        yield {"bucket": b, "chunk": chunk, "hashes": pack(v),
               "windows": w.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :_width(len(doc))].tobytes(),
               "ids": ids[present].tobytes(), "marks": None, "ends": end[present].astype(np.uint32).tobytes(),
               "n": len(v)}


def _width(n_windows: int) -> int:
    return 3 if n_windows <= 1 << 24 else 4


def _emit(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    for number, batch in enumerate(slices(batches, CHUNK_BYTES)):
        rows = list(_chunk_rows(batch, (task << 24) + number, window, buckets))
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[i:i + 64], _ARROW)


def _entries(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All entries of a bucket: value, owner's id, row, window number."""
    value, owner, row, window = [], [], [], []
    for i, r in enumerate(table.select(["hashes", "windows", "ids", "ends", "n"]).to_pylist()):
        n = r["n"]
        raw = np.zeros((n, 4), np.uint8)
        packed = np.frombuffer(r["windows"], np.uint8).reshape(n, -1)
        raw[:, :packed.shape[1]] = packed
        w = raw.view(np.uint32).ravel()
        ends = np.frombuffer(r["ends"], np.uint32)
        value.append(unpack(r["hashes"], n))
        owner.append(np.frombuffer(r["ids"], np.int64)[np.searchsorted(ends, w, "right")])
        row.append(np.full(n, i, np.int32))
        window.append(w)
    return tuple(map(np.concatenate, (value, owner, row, window)))


def _repeated(table: pa.Table) -> pa.Table:
    """Of a bucket: each chunk's windows whose value has a smaller owner elsewhere."""
    if table.column("hashes")[0].as_py() is None:
        return table.drop_columns(["bucket"])
    value, owner, row, window = _entries(table)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    late = owner > owner[np.flatnonzero(new)][np.cumsum(new) - 1]
    # Texts of one id (a repeated row) count as one text.
    row, window = row[order][late], window[order][late]
    chunks = table.column("chunk").to_numpy()
    by = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[by], np.arange(len(chunks) + 1))
    out = [{"chunk": int(chunks[i]), "hashes": None, "windows": np.sort(w).tobytes(),
            "ids": None, "marks": None, "ends": None, "n": len(w)}
           for i in range(len(chunks)) if len(w := window[by[cut[i]:cut[i + 1]]])]
    return pa.Table.from_pylist(out, _ARROW.remove(0))


def _intervals(table: pa.Table, window: int) -> pa.Table:
    """Of a chunk: each text's removal intervals [start, end) in words."""
    rows = table.to_pylist()
    flagged = np.sort(np.concatenate([np.frombuffer(r["windows"], np.uint32) for r in rows])).astype(np.int64)
    own = next(r for r in rows if r["ids"] is not None)
    ids, ends = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["ends"], np.uint32).astype(np.int64)
    doc = np.searchsorted(ends, flagged, "right")
    at = flagged - np.concatenate([[0], ends[:-1]])[doc]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + window)
    last = np.append(first[1:], True) if len(first) else first
    starts, stops, owner = at[first], at[last] + window, doc[first]
    cut = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)) if len(owner) else np.zeros(1, np.int64)
    return pa.table({
        "doc_id": pa.array(ids[owner[cut[:-1]]], pa.int64()),
        "mark": pa.array(np.frombuffer(own["marks"], np.int64)[owner[cut[:-1]]], pa.int64()),
        "starts": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(starts, pa.int32())),
        "ends": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(stops, pa.int32()))})


def removal_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Removal intervals ``[starts[i], ends[i])``, in words, of each text that has any.

    Null and empty texts, and texts shorter than a window, have none.  Rows that
    share an id are judged as one text: neither makes the other repeated.  A null
    id takes part as the smallest id of all.  Columns: doc_id, mark (a hash of the
    text, which tells rows of one id apart), starts, ends; equal rows appear once.
    """
    texts = _marked(narrow(docs, id_col, text_col)).select("key", "text", "mark")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    packed = texts.mapInArrow(lambda b: _emit(b, window, buckets), PACKED)
    found = packed.groupBy("bucket").applyInArrow(
        _repeated, "chunk long, hashes binary, windows binary, ids binary, marks binary, ends binary, n int")
    spans = found.groupBy("chunk").applyInArrow(lambda t: _intervals(t, window), SPANS)
    return stage(spans.dropDuplicates(["doc_id", "mark"]), "repeated-spans")


def _marked(texts: DataFrame) -> DataFrame:
    return texts.withColumns({"key": F.coalesce("doc_id", F.lit(-(1 << 63))), "mark": F.xxhash64("text")})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, starts, ends = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                              for c in ("text", "starts", "ends"))
        total, removed, kept = [], [], []
        for t, s, e in zip(text, starts, ends):
            words = t.encode().split() if t else []
            total.append(len(words))
            gone = 0
            for a, b in zip(reversed(s or ()), reversed(e or ())):
                gone += len(words[a:b])
                del words[a:b]
            removed.append(gone)
            kept.append(b" ".join(words))
        out = pa.table({"doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                        "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                        "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept]})
        yield from out.to_batches()


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with what is left of their texts; those of which nothing is left go."""
    for batch in batches:
        left = pa.Table.from_batches(list(_cut(iter([batch]))))
        gone, total = (left.column(c).to_numpy() for c in ("n_removed", "n_words"))
        kept = left.column("kept_text").to_pylist()
        at = batch.schema.get_field_index("text")
        texts = [k if n else t for t, k, n in zip(batch.column(at).to_pylist(), kept, gone)]
        rows = pa.Table.from_batches([batch.set_column(at, "text", pa.array(texts, pa.string()))])
        rows = rows.append_column("n_removed", pa.array(gone, pa.int64())).drop_columns(["doc_id", "starts", "ends"])
        yield from rows.filter(pa.array((gone == 0) | (gone < total))).to_batches()


def cut_rows(docs: DataFrame, window: int = 50, removed: str = "n_removed") -> DataFrame:
    """``docs`` (doc_id, text and others) without repeated passages, and a column ``removed`` of words taken out; texts
    that hold nothing else go.

    Each row is cut by its own text.  Rows of one id are one document: neither makes
    the other repeated.  Rows without an id are documents of their own, told apart by
    their columns, and come before all ids.  Other columns may have any name.
    """
    own = F.lit(-(1 << 62)) - F.pmod(row_key(docs.columns), F.lit((1 << 62) - 1))
    names = {"doc_id": "own_id", "text": "text"}
    inner = docs.toDF(*[names.get(c, f"column_{i}") for i, c in enumerate(docs.columns)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), own)).toDF(*inner.columns, "row_id").withColumn(
        "mark", F.xxhash64("text"))
    spans = removal_spans(keyed, window, "row_id").select("doc_id", F.col("mark").alias("of"), "starts", "ends")
    joined = keyed.join(spans.hint("merge"), (F.col("row_id") == F.col("doc_id")) & (F.col("mark") == F.col("of")),
                        "left").drop("row_id", "mark", "of")
    return joined.mapInArrow(_cut_rows, schema + ", n_removed long").toDF(*docs.columns, removed)


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """What is left of each text: doc_id, n_words, n_removed, kept_text, kept_sha256.

    One row per input row, in any order; kept words are joined by one space.  A
    null text counts as empty.  See ``removal_spans`` for ties and nulls.
    """
    spans = removal_spans(docs, window, id_col, text_col)
    texts = _marked(narrow(docs, id_col, text_col))
    # The same join at every size, so what it needs can be told from a small input.
    joined = texts.join(spans.hint("merge"), (texts["key"] == spans["doc_id"]) & (texts["mark"] == spans["mark"]),
                        "left").select(texts["doc_id"], "text", "starts", "ends")
    return joined.mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")

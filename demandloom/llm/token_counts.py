"""Token counts without token ids: pieces are counted once per distinct pre-token.

A pre-token here is a run without ASCII white space.  It suits tokenizers that drop
white space and never join pieces across it (their own, finer pre-tokens lie within
such runs, and so do special strings), so a text's count is the sum over its
pre-tokens.

1. Each task lists the distinct pre-tokens of chunks of texts with their
   frequencies; Spark sums these over the corpus.
2. The tokenizer counts the pieces of each distinct pre-token, once.
3. Frequent pre-tokens (at most ``FREQUENT``, so a bounded table that goes to all
   tasks) are added up where the texts are.  The rest, which no hot pre-token can
   be part of, are joined to the counts by pre-token and summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, slices, stage

#: Most entries of the table of frequent pre-tokens (16 bytes each).
FREQUENT = 500_000
CHUNK_BYTES = 8 << 20


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _grouped(batch: pa.RecordBatch, by_text: bool) -> tuple[np.ndarray, ...]:
    """Distinct pre-tokens of a slice (of each text, or of all): text number, hash,
    frequency, and where the first one lies, with the scanned words."""
    words = T.scan(batch.column(batch.schema.get_field_index("text")))
    value = words.hashes()
    doc = words.doc() if by_text else np.zeros(len(value), np.int64)
    order = np.lexsort((value, doc)) if by_text else np.argsort(value, kind="stable")
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], value[heads], np.diff(np.append(heads, len(doc))), order[heads], words


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, CHUNK_BYTES):
        _, value, freq, at, words = _grouped(batch, by_text=False)
        yield pa.RecordBatch.from_pydict({
            "piece": T.strings(words, at), "hash": pa.array(value.view(np.int64)), "freq": pa.array(freq, pa.int64())})


def _count_pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        counts = []
        for i in range(0, len(texts), 1024):
            counts += map(len, tokenizer.encode_batch_fast(texts[i:i + 1024], add_special_tokens=False))
        yield batch.append_column("pieces", pa.array(counts, pa.int64()))


def _add_up(batches: Iterator[pa.RecordBatch], table: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    known, pieces = table
    task, row = TaskContext.get().partitionId() << 33 if TaskContext.get() else 0, 0
    for batch in slices(batches):
        n = batch.num_rows
        doc, value, freq, at, words = _grouped(batch, by_text=True)
        if len(known):
            place = np.minimum(np.searchsorted(known, value), len(known) - 1)
            common = known[place] == value
            sums = np.bincount(doc[common], freq[common] * pieces[place[common]], n)
        else:
            common, sums = np.zeros(len(value), bool), np.zeros(n)
        rest = ~common
        offsets = np.searchsorted(doc[rest], np.arange(n + 1)).astype(np.int32)
        size = np.diff(T.text_bytes(batch.column(1))[1])
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(task + row + np.arange(n)), "doc_id": batch.column(0),
            "n_bytes": pa.array(size, pa.int64()), "known": pa.array(sums.astype(np.int64)),
            "rare": pa.ListArray.from_arrays(pa.array(offsets), T.strings(words, at[rest])),
            "times": pa.ListArray.from_arrays(pa.array(offsets), pa.array(freq[rest], pa.int32()))})
        row += n


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and piece counts of all pre-tokens at or over the least power of two
    of a frequency that keeps the table within ``FREQUENT`` entries."""
    level = F.floor(F.log2("freq")).cast("int")
    found = {r["level"]: r["n"] for r in counted.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # 64 rows at most
    total, least = 0, None
    for k in sorted(found, reverse=True):
        total += found[k]
        if total > FREQUENT:
            break
        least = k
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = counted.where(level >= least).select("hash", "pieces").toArrow()
    value = table.column("hash").to_numpy().view(np.uint64)
    value, at = np.unique(value, return_index=True)
    return value, table.column("pieces").to_numpy()[at]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, as the tokenizer's own encoding has
    them, without added special tokens.  A null text is empty and has 0 of both; rows
    are counted one by one, so repeated rows and null ids come out as they went in."""
    texts = narrow(docs, id_col, text_col)
    listed = texts.mapInArrow(_list, "piece string, hash long, freq long").groupBy("piece", "hash").agg(
        F.sum("freq").alias("freq"))
    counted = stage(listed.mapInArrow(
        lambda b: _count_pieces(b, tokenizer_path), "piece string, hash long, freq long, pieces long"), "pieces")
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(counted))
    summed = stage(texts.mapInArrow(
        lambda b: _add_up(b, shared.value),
        "row long, doc_id long, n_bytes long, known long, rare array<string>, times array<int>"), "token-sums")
    pairs = summed.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "row", F.col("p.rare").alias("piece"), F.col("p.times").alias("times"))
    rest = pairs.join(counted.select("piece", "pieces").hint("merge"), "piece").groupBy("row").agg(
        F.sum(F.col("times") * F.col("pieces")).alias("more"))
    return summed.select("row", "doc_id", "n_bytes", "known").join(rest.hint("merge"), "row", "left").select(
        "doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens"))

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.session import scratch_path

#: Text bytes handled at a time inside a task; a longer text is handled alone.
SLICE_BYTES = 4 << 20


def stage(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and losing an executor costs no more than the tasks it was running.

    With ``release``, the shuffle files that only the written plan needed go at once.
    Spark drops them when the driver collects garbage, which a short driver program
    with large shuffles does too seldom.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if release:
        df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under names of its own, so that other
    columns of the input can have any name."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until none of the columns has it in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def row_key(columns: list[str]) -> Column:
    """A 64-bit hash of the columns that tells rows of one id, and rows without an id, apart; nulls count."""
    return F.xxhash64(*[c for name in columns for c in (F.isnull(name), F.col(name))])


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES,
           text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of whole rows with about ``limit`` bytes of text at most.

    Small batches are joined, large ones cut; a text beyond the limit comes alone.  So no batch that this gives is cut
    again by the same limit.  A null text becomes "".
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text_col)
        text = pc.fill_null(batch.column(at), "")
        batch = batch.set_column(at, text_col, text)
        ends = pc.cumulative_sum(pc.cast(pc.binary_length(text), pa.int64())).to_numpy()
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            if held and ends[first] - before > limit - size:
                yield _joined(held)
                held, size = [], 0
            last = max(first + 1, int(ends.searchsorted(before + limit - size, "right")))
            held.append(batch.slice(first, last - first))
            size += int(ends[last - 1] - before)
            if size >= limit or last < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
            first = last
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def word_count(col: str = "text"):
    """Number of runs without ASCII white space, as a JVM expression."""
    return F.size(F.filter(F.split(F.col(col), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))

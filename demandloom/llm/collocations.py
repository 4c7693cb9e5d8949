"""Phrase collocations by counting in hash buckets.

Phrases are runs of 2 to ``longest`` words inside pieces of texts (a piece ends at a
punctuation mark or line end).  Everything is counted per language.

1. Texts are encoded in chunks, by language: distinct words and a code per word.
2. Pairs of words are counted: a chunk sends its distinct pairs by bucket of a hash, so a pair that a third of all texts
   repeat is one entry per chunk.  A bucket adds the chunks up and answers each with one bit per pair: frequent or not.
   What is left of a chunk is runs of words whose pairs are all frequent; a frequent phrase lies in such runs only.
3. The phrases of these runs are counted in the same way, told apart by 128 bits.  The bucket asks one of the chunks
   that hold a frequent phrase for its words, so a phrase leaves as a string once, with its global count.

Scores compare a phrase with its cuts: joins of the phrase table with itself.  Phrases whose words lie in a longer
candidate of (nearly) the same count go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import slices, stage
from demandloom.llm.packing import bucket_bounds, pack, unpack

#: Text bytes per chunk, and per bucket of phrases.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20

#: Bytes that end a piece: punctuation and line ends.
BREAKS = np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)
_SOLID = np.ones(256, bool)
_SOLID[[*BREAKS, 32, 9]] = False
_BREAK = np.zeros(256, np.int32)
_BREAK[BREAKS] = 1
#: The code between two pieces.
GAP = np.uint32(0xFFFFFFFF)

ENCODED = "lang string, chunk long, n long, words array<string>, times array<long>, codes binary"
PACKED = "bucket long, chunk long, hashes binary, checks binary, counts binary, n int"
_PACKED = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("checks", pa.binary()),
                     ("counts", pa.binary()), ("n", pa.int32())])
BITS = "chunk long, bucket long, n int, bits binary"
ASKED = "chunk long, bucket long, places binary, totals binary"
KEPT = "lang string, chunk long, words array<string>, codes binary"
COUNTED = "lang string, phrase string, n_words int, a long"


def encode(texts: pa.Array) -> tuple[np.ndarray, T.Words, np.ndarray, np.ndarray]:
    """Codes of all words with ``GAP`` between pieces, and where each code's word first lies and how often it occurs."""
    words = T.scan(texts, lower=True, solid=_SOLID)
    n = len(words.start)
    if not n:
        return np.zeros(0, np.uint32), words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, code, times = np.unique(words.hashes(), return_index=True, return_inverse=True, return_counts=True)
    breaks = np.zeros(len(words.data) + 1, np.int32)
    np.cumsum(_BREAK[words.data], out=breaks[1:])
    parted = np.zeros(n, bool)
    parted[1:] = breaks[words.start[1:]] != breaks[words.end[:-1]]
    parted[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < n)]] = True
    codes = np.full(n + int(parted.sum()), GAP, np.uint32)
    codes[np.arange(n) + np.cumsum(parted)] = code
    return codes, words, first, times


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _encode(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId() << 24 if TaskContext.get() else 0, 0
    for batch in slices(batches, chunk_bytes):
        langs = batch.column(batch.schema.get_field_index("lang")).to_numpy(zero_copy_only=False)
        for lang in sorted(set(langs)):
            texts = batch.column(batch.schema.get_field_index("text")).filter(pa.array(langs == lang))
            codes, words, first, times = encode(texts)
            chunk = task + number
            number += 1
            if len(codes):
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang], "chunk": pa.array([chunk], pa.int64()),
                    "n": pa.array([int(times.sum())], pa.int64()), "words": _one_list(T.strings(words, first)),
                    "times": pa.array([times], pa.list_(pa.int64())), "codes": pa.array([codes.tobytes()])})


def phrases(codes: np.ndarray, value: np.ndarray, shortest: int, longest: int,
            base: np.uint64 = T.WINDOW_BASE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of all runs of ``shortest`` to ``longest`` words; ``value`` has a hash per code."""
    alive = codes != GAP
    hashes = np.where(alive, value[np.where(alive, codes, 0)] if len(value) else np.uint64(0), np.uint64(0))
    run, whole = hashes, alive
    for k in range(2, longest + 1):
        if len(run) < 2:
            return
        run = run[:-1] * base + hashes[k - 1:]
        whole = whole[:-1] & alive[k - 1:]
        if k >= shortest:
            at = np.flatnonzero(whole)
            yield k, at, T.mix(run[at] + np.uint64(k))


def _hashed(words: pa.Array, lang: str) -> np.ndarray:
    """A hash of each word, in its language."""
    found = T.scan(pa.array([" ".join(words.to_pylist())], pa.large_string())).hashes()
    salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return T.mix(found ^ np.uint64(salt))


def _row(batch: pa.RecordBatch | pa.Table, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _chunk_phrases(words: pa.Array, codes: bytes, lang: str, shortest: int, longest: int) -> tuple[np.ndarray, ...]:
    """(length, place, hash) of all phrases of a chunk."""
    codes = np.frombuffer(codes, np.uint32)
    runs = list(phrases(codes, _hashed(words, lang), shortest, longest))
    size = np.concatenate([np.zeros(0, np.int64), *(np.full(len(at), k) for k, at, _ in runs)])
    at = np.concatenate([np.zeros(0, np.int64), *(at for _, at, _ in runs)])
    return size, at, np.concatenate([np.zeros(0, np.uint64), *(h for _, _, h in runs)])


def _chunk_checks(words: pa.Array, codes: bytes, lang: str, shortest: int, longest: int) -> np.ndarray:
    """A second hash of all phrases of a chunk, independent of the first."""
    value = T.mix(_hashed(words, lang) + T.BASE)
    runs = phrases(np.frombuffer(codes, np.uint32), value, shortest, longest, T.BASE)
    return np.concatenate([np.zeros(0, np.uint64), *(h for _, _, h in runs)])


def _distinct(value: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each pair of hashes first lies, ordered by both, and how often it occurs."""
    order = np.lexsort((check, value))
    new = np.ones(len(order), bool)
    new[1:] = (value[order[1:]] != value[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
    heads = np.flatnonzero(new)
    return order[heads], np.diff(np.append(heads, len(order)))


def _emit(batches: Iterator[pa.RecordBatch], shortest: int, longest: int, buckets: int,
          checked: bool = False) -> Iterator[pa.RecordBatch]:
    bounds = bucket_bounds(buckets)
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda c: _row(batch, c)[i]
            chunk = get("words").values, get("codes").as_py(), get("lang").as_py(), shortest, longest
            _, _, value = _chunk_phrases(*chunk)
            check = None
            if checked:
                check = _chunk_checks(*chunk)
                first, times = _distinct(value, check)
                value, check = value[first], check[first]
            else:
                value, times = np.unique(value, return_counts=True)
            cut = np.searchsorted(value, bounds)
            cut[-1] = len(value)
            rows = []
            for b in np.flatnonzero(np.diff(cut)):
                part = slice(cut[b], cut[b + 1])
                t = times[part]
                kind = "u1" if t.max() < 256 else "<u4"
                rows.append({"bucket": int(b), "chunk": get("chunk").as_py(), "hashes": pack(value[part]),
                             "checks": check[part].tobytes() if checked else None,
                             "counts": t.astype(kind).tobytes(), "n": len(t)})
            for k in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[k:k + 64], _PACKED)


def _totals(rows: list[dict], checked: bool) -> tuple[np.ndarray, ...]:
    """Entries of a bucket in the order of their phrases, the number of each one's phrase, and how often each phrase occurs."""
    value = np.concatenate([unpack(r["hashes"], r["n"]) for r in rows])
    times = np.concatenate([np.frombuffer(r["counts"], "u1" if len(r["counts"]) == r["n"] else "<u4") for r in rows])
    if checked:
        check = np.concatenate([np.frombuffer(r["checks"], np.uint64) for r in rows])
        order = np.lexsort((check, value))
    else:
        order = np.argsort(value, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = value[order[1:]] != value[order[:-1]]
    if checked:
        new[1:] |= check[order[1:]] != check[order[:-1]]
    return order, np.cumsum(new) - 1, np.add.reduceat(times[order].astype(np.int64), np.flatnonzero(new))


def _mine(table: pa.Table, support: int) -> pa.Table:
    """Of a bucket: which phrases reach the support, as bits for each chunk."""
    rows = table.to_pylist()
    n = np.array([r["n"] for r in rows])
    order, phrase, total = _totals(rows, False)
    kept = np.zeros(len(order), bool)
    kept[order] = total[phrase] >= support
    parts = np.split(kept, np.cumsum(n)[:-1])
    use = [i for i, p in enumerate(parts) if p.any()]
    return pa.table({
        "chunk": pa.array([rows[i]["chunk"] for i in use], pa.int64()),
        "bucket": pa.array([rows[i]["bucket"] for i in use], pa.int64()),
        "n": pa.array([rows[i]["n"] for i in use], pa.int32()),
        "bits": pa.array([np.packbits(parts[i]).tobytes() for i in use], pa.binary())})


def _ask(table: pa.Table, support: int) -> pa.Table:
    """Of a bucket: the phrases that reach the support, each with its count for one of the chunks that have it."""
    rows = table.to_pylist()
    n = np.array([r["n"] for r in rows])
    order, phrase, total = _totals(rows, True)
    use = total[phrase] >= support
    entry, phrase = order[use], phrase[use]
    row = np.repeat(np.arange(len(rows)), n)[entry]
    chunk = np.array([r["chunk"] for r in rows]).astype(np.uint64)
    # Any chunk will do; a hash spreads the phrases that all chunks have.
    turn = np.lexsort((T.mix(T.mix(phrase.astype(np.uint64)) ^ chunk[row]), phrase))
    one = np.ones(len(turn), bool)
    one[1:] = phrase[turn[1:]] != phrase[turn[:-1]]
    turn = turn[one]
    turn = turn[np.lexsort((entry[turn], row[turn]))]
    first = (np.cumsum(n) - n)[row[turn]]
    place, count, row = (entry[turn] - first).astype("<u4"), total[phrase[turn]], row[turn]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    cuts = list(zip(heads, np.append(heads[1:], len(row)))) if len(row) else []
    return pa.table({
        "chunk": pa.array([rows[row[i]]["chunk"] for i, _ in cuts], pa.int64()),
        "bucket": pa.array([rows[row[i]]["bucket"] for i, _ in cuts], pa.int64()),
        "places": pa.array([place[i:j].tobytes() for i, j in cuts], pa.binary()),
        "totals": pa.array([count[i:j].astype("<i8").tobytes() for i, j in cuts], pa.binary())})


def _frequent_pairs(chunk: pa.Table, found: pa.Table, buckets: int) -> np.ndarray:
    """Places of the frequent pairs of a chunk."""
    get = lambda c: _row(chunk, c)[0]
    _, at, value = _chunk_phrases(get("words").values, get("codes").as_py(), get("lang").as_py(), 2, 2)
    value, number = np.unique(value, return_inverse=True)
    cut = np.searchsorted(value, bucket_bounds(buckets))
    kept = np.zeros(len(value), bool)
    for r in found.to_pylist():
        first = cut[r["bucket"]]
        kept[first:first + r["n"]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).view(bool)
    return at[kept[number]]


def _runs(key: tuple, chunk: pa.Table, found: pa.Table, buckets: int) -> pa.Table:
    """What is left of a chunk: runs of words whose pairs are all frequent."""
    empty = pa.table({c: pa.array([], t) for c, t in zip(
        ("lang", "chunk", "words", "codes"), (pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary()))})
    if not chunk.num_rows or not found.num_rows:
        return empty
    codes = np.frombuffer(_row(chunk, "codes")[0].as_py(), np.uint32)
    pair = np.zeros(len(codes) + 1, bool)
    pair[_frequent_pairs(chunk, found, buckets)] = True
    used = pair[:-1].copy()
    used[1:] |= pair[:-2]
    # A gap after each word that does not go on to the next.
    places = np.flatnonzero(used)
    goes_on = pair[places]
    out = np.full(len(places) + int((~goes_on).sum()), GAP, np.uint32)
    present, code = np.unique(codes[places], return_inverse=True)
    out[np.arange(len(places)) + np.cumsum(~goes_on) - ~goes_on] = code
    words = _row(chunk, "words")[0].values.take(pa.array(present.astype(np.int64)))
    return pa.table({
        "lang": _row(chunk, "lang"), "chunk": _row(chunk, "chunk"), "words": _one_list(words.cast(pa.string())),
        "codes": pa.array([out.tobytes()], pa.binary())})


def _name(key: tuple, chunk: pa.Table, asked: pa.Table, longest: int, buckets: int) -> pa.Table:
    """The phrases that a chunk is asked for as strings, with their global counts."""
    texts, lang, size, total = [], None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if chunk.num_rows and asked.num_rows:
        get = lambda c: _row(chunk, c)[0]
        lang = get("lang").as_py()
        known = get("words").values, get("codes").as_py(), lang, 2, longest
        size, at, value = _chunk_phrases(*known)
        first, _ = _distinct(value, _chunk_checks(*known))
        cut = np.searchsorted(value[first], bucket_bounds(buckets))
        rows = asked.to_pylist()
        use = first[np.concatenate([cut[r["bucket"]] + np.frombuffer(r["places"], "<u4") for r in rows])]
        total = np.concatenate([np.frombuffer(r["totals"], "<i8") for r in rows])
        words, codes = np.array(get("words").as_py(), object), np.frombuffer(known[1], np.uint32)
        size = size[use]
        texts = [" ".join(words[codes[i:i + k]]) for i, k in zip(at[use], size)]
    return pa.table({"lang": pa.array([lang] * len(texts), pa.string()), "phrase": pa.array(texts, pa.string()),
                     "n_words": pa.array(size, pa.int32()), "a": pa.array(total, pa.int64())})


def _frequent_counts(docs: DataFrame, support: int, longest: int, lang_col: str, text_col: str,
                     chunk_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), the frequent words (lang, phrase, a) and the frequent phrases (lang, phrase, n_words, a)."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    amount = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-amount // BUCKET_BYTES))
    encoded = stage(texts.mapInArrow(lambda b: _encode(b, chunk_bytes), ENCODED), "phrase-chunks")
    totals = stage(encoded.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words = encoded.select("lang", F.explode(F.arrays_zip("words", "times")).alias("w")).groupBy(
        "lang", F.col("w.words").alias("phrase")).agg(F.sum("w.times").alias("a")).where(F.col("a") >= support)

    chunks = encoded.select("lang", "chunk", "words", "codes")
    pairs = chunks.mapInArrow(lambda b: _emit(b, 2, 2, buckets), PACKED).groupBy("bucket").applyInArrow(
        lambda t: _mine(t, support), BITS)
    runs = stage(chunks.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(
        lambda k, a, b: _runs(k, a, b, buckets), KEPT), "phrase-runs")
    asked = runs.mapInArrow(lambda b: _emit(b, 2, longest, buckets, True), PACKED).groupBy("bucket").applyInArrow(
        lambda t: _ask(t, support), ASKED)
    return totals, words, runs.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(
        lambda k, a, b: _name(k, a, b, longest, buckets), COUNTED)


def _words_of(text: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split(text, " ", -1), first, size), " ")


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, most: int = 2000, factor: int = 1000,
                 closeness: int = 100, lang_col: str = "lang", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of at least ``support`` occurrences, cut after its first k words, scores
    floor(``factor`` * a * n / (l * r)) with a, l, r the occurrences of phrase, first part and rest and n the words of
    the language; its lowest cut counts, of equal ones the first.  Phrases inside a longer candidate with
    ``closeness`` percent of their occurrences go.  Ties of the score go to the larger a, then to the phrase first in
    byte order.  A null language is ``und``, a null text empty.  Repeated rows count as often as they occur; no rows,
    or none with enough words, give no phrases.  Other columns are ignored.
    """
    totals, words, frequent = _frequent_counts(docs, support, longest, lang_col, text_col, chunk_bytes)
    found = stage(frequent, "phrase-found")
    known = stage(words.select("lang", "phrase", "a").unionByName(found.select("lang", "phrase", "a")), "phrase-parts")

    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang", "phrase", "n_words", "a", "k", _words_of(F.col("phrase"), F.lit(1), F.col("k")).alias("head"),
        _words_of(F.col("phrase"), F.col("k") + 1, F.col("n_words") - F.col("k")).alias("tail"))
    part = lambda side, value: known.select(
        "lang", F.col("phrase").alias(side), F.col("a").alias(value))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(
        totals, "lang").withColumn("score", F.call_function("div", F.lit(factor).cast("decimal(38,0)") * big("a") * big("n"),
                                                            big("l") * big("r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = found.where("n_words > 2").select(
        "lang", "a", "n_words", "phrase", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size")).select(
        "lang", "a", "n_words", "phrase", "size", F.explode(F.sequence(
            F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("first"))
    inside = inside.select("lang", _words_of(F.col("phrase"), F.col("first"), F.col("size")).alias("part"), "a").groupBy(
        "lang", "part").agg(F.max("a").alias("longer"))
    free = lowest.join(inside.select(F.col("lang").alias("of"), "part", "longer"), (F.col("lang") == F.col("of")) & (
        F.col("phrase") == F.col("part")), "left").where(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * closeness))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return free.select("lang", "phrase", "a", "n", "cut.*").withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= most).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                      F.col("score").cast("long").alias("score"))

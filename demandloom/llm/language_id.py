"""Language identification by inferring the mixture of languages of each text.

Learning counts byte trigrams of the words of labelled texts per language, over
all learning rows.  The model is the smoothed log-probability of each trigram in
each language.

A text's words have a likelihood in each language, the product of their trigrams'.
Expectation-maximisation finds the language proportions under which the words are
likeliest.  It runs on the full set of languages and on the nested sets of its
largest ones; the set with the best likelihood, less a penalty of half the
logarithm of the number of words for each language, is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, slices

#: Trigram slots, added count of each, EM rounds, languages at most.
SLOTS, SMOOTH, ROUNDS, MOST_LANGUAGES = 1 << 16, 0.2, 12, 256
#: A word counts as at most this much evidence, in trigrams.
WORD_LIMIT = 12.0
#: Text bytes handled at a time.  The numbers kept per byte, and per word and language, take many times as much.
SLICE_BYTES = 512 << 10

UNKNOWN = "und"
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

PREDICTED = "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"


def trigrams(texts: pa.Array) -> tuple[T.Words, np.ndarray]:
    """Letter words of lower-cased texts, and the slot of the trigram around each byte."""
    lowered = pa.array([t.lower() for t in texts.to_pylist()], pa.large_string())
    words = T.scan(lowered, solid=_LETTERS)
    raw = np.where(_LETTERS[words.data], words.data, 32).astype(np.uint32)
    # A text's edge is like a space.
    around = np.full(len(raw) + 2, 32, np.uint32)
    around[1:-1] = raw
    before, after = around[:-2].copy(), around[2:].copy()
    before[words.start] = 32
    after[words.end - 1] = 32
    code = (before << np.uint32(16)) | (raw << np.uint32(8)) | after
    return words, ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number: dict[str, int] = {}
    totals = np.zeros(0, np.int64)
    for batch in slices(batches, SLICE_BYTES):
        words, slot = trigrams(batch.column(batch.schema.get_field_index("text")))
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        numbers = np.array([number.setdefault(x, len(number)) for x in langs])
        if len(totals) < len(number) * SLOTS:
            totals = np.append(totals, np.zeros(len(number) * SLOTS - len(totals), np.int64))
        inside = np.zeros(len(slot) + 1, np.int64)
        np.add.at(inside, words.start, 1)
        np.add.at(inside, words.end, -1)
        inside = np.cumsum(inside)[:-1] > 0
        lang = np.repeat(numbers[words.doc()], words.end - words.start)
        np.add.at(totals, lang * SLOTS + slot[inside], 1)
    for name, row in zip(number, totals.reshape(-1, SLOTS)):
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([name] * len(at), pa.string()), "slot": pa.array(at, pa.int32()),
            "n": pa.array(row[at], pa.int64())})


@dataclass
class Model:
    names: list[str]
    logs: np.ndarray  # one row per language, one column per slot


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Count trigrams over all rows of ``docs`` with a language and a text.

    What reaches the driver is one number per language and slot, so it is bounded
    by ``MOST_LANGUAGES``; more languages are an error.  No rows give no languages.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    if rows.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = rows.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n"))
    table = counts.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    full = np.full((len(names), SLOTS), SMOOTH)
    place = {n: i for i, n in enumerate(names)}
    lang = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    np.add.at(full, (lang, table.column("slot").to_numpy()), table.column("n").to_numpy())
    return Model(names, np.log(full / full.sum(axis=1, keepdims=True)))


def _proportions(likely: np.ndarray, counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over words: (proportions, log-likelihood) per text of ``counts`` words (at
    least one each, one text after another); ``allowed`` has a row per text."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    heads = np.cumsum(counts) - counts
    for _ in range(ROUNDS):
        part = np.repeat(share, counts, axis=0) * likely
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(part, heads, axis=0) / counts[:, None]
    total = np.log(np.maximum((np.repeat(share, counts, axis=0) * likely).sum(axis=1), 1e-300))
    return share, np.add.reduceat(total, heads)


def infer(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (a row per text) of the chosen language sets, and whether any word spoke."""
    n, width = len(texts), len(model.names)
    words, slot = trigrams(texts)
    spoke = words.counts > 0
    out = np.zeros((n, width))
    if not width or not len(words.start):
        return out, np.zeros(n, bool)
    logs = np.stack([np.add.reduceat(row[slot], words.start) for row in _masked(model, slot, words)], axis=1)
    length = np.maximum(words.end - words.start, 1)[:, None]
    logs *= np.minimum(1.0, WORD_LIMIT / length)
    likely = np.exp(logs - logs.max(axis=1, keepdims=True))
    counts = words.counts[spoke]
    cost = 0.5 * np.log(np.maximum(counts, 2))
    chosen, value = _proportions(likely, counts, np.ones((len(counts), width)))
    best = value - cost * width
    rank = np.argsort(np.argsort(-chosen, axis=1, kind="stable"), axis=1)
    for size in range(min(width - 1, 3), 0, -1):
        on = (rank < size).astype(float)
        if size == 1:  # nothing to infer
            alone = np.log(np.maximum((np.repeat(on, counts, axis=0) * likely).sum(axis=1), 1e-300))
            tried, value = on, np.add.reduceat(alone, np.cumsum(counts) - counts)
        else:
            tried, value = _proportions(likely, counts, on)
        better = value - cost * size >= best
        best = np.where(better, value - cost * size, best)
        chosen = np.where(better[:, None], tried, chosen)
    out[spoke] = chosen
    return out, spoke


def _masked(model: Model, slot: np.ndarray, words: T.Words) -> Iterator[np.ndarray]:
    """Each language's values by slot; bytes between words are worth nothing."""
    gap = np.ones(len(slot), bool)
    gap[np.repeat(words.start - np.cumsum(words.end - words.start) + (words.end - words.start),
                  words.end - words.start) + np.arange((words.end - words.start).sum())] = False
    slot[gap] = SLOTS
    for row in model.logs:
        yield np.append(row, 0.0)


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        texts = batch.column(1)
        share, spoke = infer(texts, model)
        any_letter = np.array([any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
        known = any_letter & (len(model.names) > 0)
        out = []
        for i in range(batch.num_rows):
            if not known[i]:
                out.append((UNKNOWN, 0.0, [], []))
                continue
            order = np.argsort(-share[i], kind="stable")
            used = [k for k in order if share[i, k] > 0.005] or [order[0]]
            out.append((model.names[order[0]], float(min(1.0, share[i, order[0]])),
                        [model.names[k] for k in used], [float(share[i, k]) for k in used]))
        lang, score, langs, shares = zip(*out)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()),
            "languages": pa.array(langs, pa.list_(pa.string())), "shares": pa.array(shares, pa.list_(pa.float64()))})


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages, shares) of every row.

    lang_pred is the language with the largest share, score that share; languages
    and shares list the chosen set, largest first.  A null text, one without a
    letter, or any text under a model without languages, is ``und`` with score 0.
    Ties go to the name that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_LANGUAGES * SLOTS numbers at most
    return narrow(docs, id_col, text_col).mapInArrow(lambda b: _predict(b, shared.value), PREDICTED)


def _keep(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        verdict = pa.Table.from_batches(_predict(iter([batch.select(["doc_id", "text"])]), model)).combine_chunks()
        lang = verdict.column("lang_pred")
        sure = pc.and_(pc.not_equal(lang, UNKNOWN), pc.greater_equal(verdict.column("score"), least))
        at = batch.schema.get_field_index("lang")
        filled = pa.Table.from_batches([batch]).set_column(at, "lang", pc.coalesce(batch.column(at), lang))
        yield from filled.filter(sure).to_batches()


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (columns doc_id, text and lang, and others) whose language is
    known: not ``und``, and with a share of ``least`` in the text.  A null lang is
    filled with the prediction.  Every row is judged by its own text: null ids and
    repeated rows come out as they went in.  Rows pass through the tasks without a
    shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda b: _keep(b, shared.value, least), docs.schema)


def learning_fold(id_col: str = "doc_id") -> Column:
    """Rows that language models may learn from; the others are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2

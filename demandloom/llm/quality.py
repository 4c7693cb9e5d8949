"""Text quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are known good texts; everything else of the web is unlabelled.
With a class prior p, the risk of a scorer is

    p * risk(positives as positive) + max(0, risk(unlabelled as negative)
                                             - p * risk(positives as negative)),

whose second part is kept from going below zero, where it would only fit noise.
The scorer is a small network on surface measures of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import narrow, slices, stage

#: Rows of each kind that the network is fitted on, at most (in expectation).
POSITIVES, UNLABELLED = 20_000, 40_000
HIDDEN, EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 24, 40, 2000, 512, 5e-3, 1e-4

MEASURES = ("log_words", "word_length", "long_words", "capital_words", "upper", "digits", "accents", "marks",
            "commas", "exclaimed", "marked_ends", "lone_marks", "repeats", "repeats_near", "distinct", "lines",
            "stops", "short_words")


def measures(texts: pa.Array) -> np.ndarray:
    """One row of ``MEASURES`` per text; an empty text has zeros only."""
    n = len(texts)
    w = T.scan(texts)
    raw, bounds = T.text_bytes(texts)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    doc, count = w.doc(), w.counts
    size = w.end - w.start
    first = w.data[w.start] if len(doc) else np.zeros(0, np.uint8)
    last = w.data[w.end - 1] if len(doc) else first
    of_words = lambda v: np.bincount(doc, v, n) / np.maximum(count, 1)
    of_bytes = lambda on: np.bincount(owner[on], minlength=n) / np.maximum(np.diff(bounds), 1)
    letter = T.PLAIN[raw] & ~((raw >= 48) & (raw <= 57))
    mark = (raw > 32) & ~T.PLAIN[raw]
    upper = (raw >= 65) & (raw <= 90)
    value = w.hashes()
    again, near = np.zeros(len(doc)), np.zeros(len(doc))
    again[1:] = (value[1:] == value[:-1]) & (doc[1:] == doc[:-1])
    near[2:] = (value[2:] == value[:-2]) & (doc[2:] == doc[:-2])
    kinds = np.bincount(T.distinct(doc, value)[0], minlength=n)
    plain_end = T.PLAIN[last]
    return np.stack([
        np.log1p(count) / 10, np.minimum(of_words(size) / 20, 2), of_words(size > 20), of_words((first >= 65) & (first <= 90)),
        of_bytes(upper), of_bytes((raw >= 48) & (raw <= 57)), of_bytes(raw >= 128), of_bytes(mark),
        of_bytes(raw == 44), of_words(last == 33), of_words(~plain_end & ~np.isin(last, np.frombuffer(b".,;:!?", np.uint8))),
        of_words((size == 1) & ~plain_end), of_words(again), of_words(near), kinds / np.maximum(count, 1),
        np.minimum(of_bytes(raw == 10) * 20, 2), of_words(last == 46), of_words(size <= 3) * (np.bincount(owner[letter], minlength=n) > 0),
    ], axis=1).astype(np.float32)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x = measures(batch.column(1))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "x": pa.FixedSizeListArray.from_arrays(
                pa.array(x.ravel()), len(MEASURES)).cast(pa.list_(pa.float32()))})


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.layers, self.prepare(x))[1]

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x)))


def _forward(layers: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, np.clip(hidden @ w2 + b2[0], -30, 30)


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 3) -> Scorer:
    """Minimise the non-negative risk with the logistic loss, by Adam on batches.

    Where a batch's negative part falls below zero, the step goes the other way on
    that part alone.  Without positives or unlabelled rows the score is the prior.
    """
    rng = np.random.default_rng(seed)
    width = len(MEASURES)
    pool = np.concatenate([positives, unlabelled]) if len(positives) + len(unlabelled) else np.zeros((1, width))
    scorer = Scorer(pool.mean(axis=0), pool.std(axis=0) + 1e-3, (
        rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
        np.array([np.log(prior / (1 - prior))])))
    if not len(positives) or not len(unlabelled):
        return scorer
    scorer.layers[2][:] = rng.normal(0, 0.1, HIDDEN)
    p, u = scorer.prepare(positives), scorer.prepare(unlabelled)
    first = [np.zeros_like(x) for x in scorer.layers]
    second = [np.zeros_like(x) for x in scorer.layers]
    step, steps = 0, max(1, len(u) // BATCH)
    epochs = max(EPOCHS, LEAST_STEPS // steps)
    for epoch in range(epochs):
        order_u, order_p = rng.permutation(len(u)), rng.permutation(len(p))
        for i in range(steps):
            xu = u[order_u[i::steps]]
            xp = p[order_p[i % max(1, len(p) // BATCH)::max(1, len(p) // BATCH)]]
            x = np.concatenate([xp, xu])
            hidden, z = _forward(scorer.layers, x)
            s = 1 / (1 + np.exp(-z))
            sp, su = s[:len(xp)], s[len(xp):]
            loss_neg = lambda v: -np.log(np.maximum(1 - v, 1e-12)).mean()
            rest = loss_neg(su) - prior * loss_neg(sp)
            slope = np.zeros_like(z)
            if rest >= 0:
                slope[:len(xp)] = prior * (sp - 1) / len(xp) - prior * sp / len(xp)
                slope[len(xp):] = su / len(xu)
            else:
                slope[:len(xp)] = prior * sp / len(xp)
                slope[len(xp):] = -su / len(xu)
            back = np.outer(slope, scorer.layers[2]) * (1 - hidden ** 2)
            grads = (x.T @ back + DECAY * scorer.layers[0], back.sum(axis=0),
                     hidden.T @ slope + DECAY * scorer.layers[2], np.array([slope.sum()]))
            step += 1
            rate = RATE * (1 - epoch / epochs) + 1e-4
            for value, g, m, v in zip(scorer.layers, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return scorer


def _sample(rows: DataFrame, most: int, seed: int) -> np.ndarray:
    """Measures of about ``most`` rows, chosen by a hash of the id; all, if fewer."""
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int(most / n * (1 << 30)))
    x = rows.select("x").toArrow().column("x").combine_chunks()
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return np.asarray(x.flatten(), np.float32).reshape(-1, len(MEASURES)).astype(float)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the measures of every row; a null text counts as empty."""
    return narrow(docs, id_col, text_col).mapInArrow(_measure, "doc_id long, x array<float>")


def train(measured: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality") -> Scorer:
    """Fit on the rows of ``measured`` for which ``learn`` holds.

    Positives are rows with label 1, unlabelled those without a label.  The prior
    is the share of 1 among all labelled learning rows, kept within 0.01 and 0.99;
    labels of 0 serve nothing else.  Of several labels of one id the highest counts.
    """
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.col(label_col).cast("int")).alias("label"))
    rows = measured.where(learn).join(marks.hint("merge"), F.col("doc_id") == F.col("labelled"), "left").select(
        "doc_id", "x", "label")
    rows = stage(rows, "quality-rows")
    found = {r["label"]: r["n"] for r in rows.groupBy((F.col("label") > 0).alias("label")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # three rows
    good, bad = found.get(True, 0), found.get(False, 0)
    prior = min(0.99, max(0.01, good / (good + bad))) if good + bad else 0.5
    return fit(_sample(rows.where("label = 1"), POSITIVES, 1), _sample(rows.where("label is null"), UNLABELLED, 2), prior)


def _score(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = np.asarray(batch.column(1).flatten(), np.float32).reshape(-1, len(MEASURES)).astype(float)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "score": pa.array(scorer.scores(x), pa.float64())})


def score(measured: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score) of every measured row; score is in 0 to 1, higher is better."""
    return measured.select("doc_id", "x").mapInArrow(lambda b: _score(b, scorer), "doc_id long, score double")

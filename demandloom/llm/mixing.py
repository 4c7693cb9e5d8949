"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents fall into cells of source, language and topic.  Each cell's token weight
is raked until its marginals have the target shares; a document is sampled with
the probability that its cell's weight implies.

Cells are counted in Spark over all documents.  Their number is bounded by the
targets: values without a target share one cell each ("other"), so the table that
is raked on the driver has at most (sources + 1) * (languages + 1) * (topics + 1)
rows whatever the corpus holds.

``mix_all`` has a target for every source.  A round of raking needs one pass over the
sources, each with its cells of language and topic; it runs on the driver up to
``MOST_CELLS`` cells and in Spark beyond.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import tokens as T
from demandloom.llm.common import slices, stage

OTHER = "(other)"
#: Surface topics that ``measure`` knows, in the order of their tests.
TOPICS = ("blank", "table", "symbols", "shouting", "repeats", "short", "prose")
#: Most cells that targets may make; what is raked on the driver and joined by broadcast.
MOST_CELLS = 200_000
#: Part of all tokens that ``mix_all`` keeps in expectation.
BUDGET_SHARE = 0.5
#: Languages with a target of their own; rounds of raking over all sources, and the change of a factor that ends them.
MOST_LANGS, ROUNDS, CLOSE = 4096, 100, 1e-7


def _measure(batches: Iterator[pa.RecordBatch], drop: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n = batch.num_rows
        w = T.scan(batch.column(batch.schema.get_field_index("text")))
        count, doc = w.counts, w.doc()
        share = lambda on: np.bincount(doc, on, n) / np.maximum(count, 1)
        first = w.data[w.start] if len(w.start) else np.zeros(0, np.uint8)
        last = w.data[w.end - 1] if len(w.start) else first
        size = w.end - w.start
        hashes = w.hashes()
        again = np.zeros(len(doc), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        marks = np.isin(last, np.frombuffer(b"#$%&*@", np.uint8)) & (size > 2)
        tests = [count == 0, share((first == 124) & (size == 1)) >= 0.2, share(marks) >= 0.2,
                 share((first >= 65) & (first <= 90) & (last == 33)) >= 0.3, share(again) >= 0.3, count < 50]
        topic = np.select(tests, range(len(tests)), len(tests))
        yield pa.RecordBatch.from_pydict({
            **{f: batch.column(k) for k, f in enumerate(batch.schema.names) if f not in drop},
            "topic": pa.array([TOPICS[k] for k in topic], pa.string()), "n_tokens": pa.array(count, pa.int64())})


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang", keep_text: bool = False) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens): words of each whole text, and its
    surface topic, one of ``TOPICS``; with ``keep_text`` also text.  Null texts are
    blank (and are kept as ""); nulls elsewhere stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"))
    drop = () if keep_text else ("text",)
    columns = [c for c in ("doc_id long", "text string", "source string", "lang string") if c.split()[0] not in drop]
    return rows.mapInArrow(lambda b: _measure(b, drop), ", ".join([*columns, "topic string", "n_tokens long"]))


def rake(weights: np.ndarray, targets: list[np.ndarray], rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Iterative proportional fitting of a table to its marginals' target shares.

    Rows of a marginal without weight cannot be raised; their share goes to the
    others in proportion.  A target of 0 empties its row.
    """
    fitted = weights.astype(float)
    total = fitted.sum()
    if total <= 0:
        return fitted
    for _ in range(rounds):
        moved = 0.0
        for axis, target in enumerate(targets):
            rest = tuple(a for a in range(fitted.ndim) if a != axis)
            now = fitted.sum(axis=rest)
            want = np.where(now > 0, target, 0.0)
            if want.sum() <= 0:
                continue
            want = want * total / want.sum()
            factor = np.divide(want, now, out=np.zeros_like(now), where=now > 0)
            moved = max(moved, float(np.abs(now - want).max()) / total)
            fitted *= factor.reshape([-1 if a == axis else 1 for a in range(fitted.ndim)])
        if moved < close:
            break
    return fitted


def tempered(shares: Mapping[str, float], power: float = 0.5) -> dict[str, float]:
    """Target shares between the present ones (power 1) and equal ones (power 0)."""
    raised = {k: v ** power for k, v in shares.items() if v > 0}
    return {k: v / sum(raised.values()) for k, v in raised.items()} if raised else {}


def _bucket(col: str, target: Mapping[str, float]):
    return F.when(F.col(col).isin([k for k in target if k != OTHER]), F.col(col)).otherwise(F.lit(OTHER))


def probabilities(cells: np.ndarray, fitted: np.ndarray, budget: float | None) -> np.ndarray:
    """Sampling probability of each cell's tokens.

    Without a budget the largest sample that keeps the weights exact is taken: the
    cell that is shortest of its weight is kept whole.  With one, probabilities rise
    in proportion until the expected tokens reach it, whole cells staying whole.
    """
    ratio = np.divide(fitted, cells, out=np.zeros_like(fitted), where=cells > 0)
    if ratio.max(initial=0) <= 0:
        return ratio
    if budget is None:
        return ratio / ratio.max()
    low, high = 0.0, 1.0 / ratio[ratio > 0].min()
    for _ in range(200):
        mid = (low + high) / 2
        if (np.minimum(1.0, mid * ratio) * cells).sum() < budget:
            low = mid
        else:
            high = mid
    return np.minimum(1.0, high * ratio)


def mix(measured: DataFrame, sources: Mapping[str, float], langs: Mapping[str, float], topics: Mapping[str, float],
        budget_share: float | None = None, seed: int = 17) -> DataFrame:
    """Every measured row with ``weight``, ``probability`` and ``sampled``.

    Targets map values to shares; they are scaled to 1.  Values without a target,
    and nulls, count as "(other)", which has weight 0 unless the target names it.
    weight is the factor on the cell's tokens that gives all marginals their target.
    ``budget_share`` is the part of all tokens to keep in expectation.  Sampling is
    by a hash of id and seed, so reruns and repeated rows agree.  Documents without
    tokens weigh nothing in the marginals and share the probability of their cell.
    """
    targets = [dict(sources), dict(langs), dict(topics)]
    names = [sorted({*t, OTHER}) for t in targets]
    if np.prod([len(x) for x in names]) > MOST_CELLS:
        raise ValueError(f"the targets make more than {MOST_CELLS} cells")
    keyed = measured.withColumns({f"cell_{c}": _bucket(c, t) for c, t in zip(("source", "lang", "topic"), targets)})
    keys = ["cell_source", "cell_lang", "cell_topic"]
    cells = np.zeros([len(x) for x in names])
    place = [{k: i for i, k in enumerate(x)} for x in names]
    for row in keyed.groupBy(*keys).agg(F.sum("n_tokens").alias("n")).collect():  # at most MOST_CELLS rows
        cells[tuple(p[row[k]] for p, k in zip(place, keys))] = row["n"] or 0
    fitted = rake(cells, [np.array([t.get(k, 0.0) for k in x]) for t, x in zip(targets, names)])
    budget = None if budget_share is None else budget_share * cells.sum()
    chance = probabilities(cells, fitted, budget)
    weight = np.divide(fitted, cells, out=np.zeros_like(fitted), where=cells > 0)
    rows = [(*(x[i] for x, i in zip(names, at)), float(weight[at]), float(chance[at]))
            for at in zip(*np.nonzero(cells))]
    table = measured.sparkSession.createDataFrame(
        rows, "s string, l string, t string, weight double, probability double")
    joined = keyed.join(F.broadcast(table), [  # at most MOST_CELLS rows
        F.col("cell_source") == F.col("s"), F.col("cell_lang") == F.col("l"), F.col("cell_topic") == F.col("t")], "left")
    return _sampled(joined, measured.columns, seed)


def _sampled(joined: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """Rows without an id are drawn by their other columns, so that they do not share one draw."""
    by_row = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
    drawn = F.when(F.col("doc_id").isNull(), by_row).otherwise(F.xxhash64(F.col("doc_id"), F.lit(seed)))
    draw = F.pmod(drawn, F.lit(1 << 53)) / float(1 << 53)
    return joined.select(*columns, F.coalesce("weight", F.lit(0.0)).alias("weight"),
                         F.coalesce("probability", F.lit(0.0)).alias("probability")).withColumn(
        "sampled", draw < F.col("probability"))


def shares(measured: DataFrame, col: str, most: int = 256) -> dict[str, float]:
    """Token share of the ``most`` values with most tokens; the rest is "(other)"."""
    rows = measured.where(F.col(col).isNotNull()).groupBy(col).agg(F.sum("n_tokens").alias("n"))
    total = measured.agg(F.sum("n_tokens")).first()[0] or 0
    top = {r[0]: r[1] for r in rows.orderBy(F.desc("n"), col).limit(most).collect() if r[1]}
    if total > sum(top.values()):
        top[OTHER] = total - sum(top.values())
    return {k: v / total for k, v in top.items()} if total else {}


def _factors(batch: pa.RecordBatch, g: np.ndarray, power: float) -> tuple[np.ndarray, ...]:
    """(source's number, place, tokens, weight) of each cell of the batch's sources."""
    place, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
    size = np.diff(batch.column(1).offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    now = np.bincount(row, n * g[place], len(size))
    want = np.bincount(row, n, len(size)) ** power
    factor = np.divide(want, now, out=np.zeros_like(now), where=now > 0)
    return row, place, n, factor[row] * g[place]


def _sums(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"at": pa.array(range(len(values)), pa.int32()), "value": pa.array(values, pa.float64())})


def _places(batches: Iterator[pa.RecordBatch], g: np.ndarray, power: float) -> Iterator[pa.RecordBatch]:
    """Weighted tokens of each place, sources fitted to their targets."""
    for batch in batches:
        _, place, n, weight = _factors(batch, g, power)
        yield _sums(np.bincount(place, n * weight, len(g)))


def _kept(batches: Iterator[pa.RecordBatch], g: np.ndarray, power: float, tries: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Expected tokens at each try of the factor between weight and probability."""
    for batch in batches:
        _, _, n, weight = _factors(batch, g, power)
        yield _sums(np.array([(np.minimum(1.0, c * weight) * n).sum() for c in tries]))


def _cells(batches: Iterator[pa.RecordBatch], g: np.ndarray, power: float, names: list[tuple[str, str]], scale: float,
           c: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, place, _, weight = _factors(batch, g, power)
        yield pa.RecordBatch.from_pydict({
            "s": batch.column(0).take(pa.array(row)), "l": pa.array([names[i][0] for i in place], pa.string()),
            "t": pa.array([names[i][1] for i in place], pa.string()), "weight": pa.array(weight * scale),
            "probability": pa.array(np.minimum(1.0, c * weight))})


def mix_all(measured: DataFrame, counts: DataFrame | None = None, power: float = 0.5, budget_share: float = BUDGET_SHARE,
            seed: int = 17) -> DataFrame:
    """Like ``mix``, with a target for every source and language there is: its share of tokens to the ``power``;
    topics keep their shares.  Cells too scarce for their weight are kept whole, the others share the rest of the
    budget.  ``counts`` are the measured rows without their texts, if they are stored; they are read several times."""
    counts = measured if counts is None else counts
    targets = [tempered(shares(counts, "lang", MOST_LANGS), power), shares(counts, "topic")]
    langs, topics = (sorted({*t, OTHER}) for t in targets)
    names = [(a, b) for a in langs for b in topics]
    keys = {"cell_source": F.coalesce("source", F.lit(OTHER)), "cell_lang": _bucket("lang", targets[0]),
            "cell_topic": _bucket("topic", targets[1])}
    number = lambda c, x: F.array_position(F.array(*map(F.lit, x)), F.col(c)) - 1
    cells = counts.withColumns(keys).groupBy(*keys).agg(F.sum("n_tokens").alias("n")).where("n > 0").select(
        "cell_source", (number("cell_lang", langs) * len(topics) + number("cell_topic", topics)).cast("int").alias("place"),
        "n")
    cell = F.collect_list(F.struct("place", "n"))
    sources = stage(cells.groupBy(F.col("cell_source").alias("s")).agg(cell.alias("c")).select(
        "s", "c.place", "c.n"), "mixing-sources")
    n_cells, total = sources.agg(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    small = (n_cells or 0) <= MOST_CELLS
    local = sources.toArrow().combine_chunks().to_batches() if small else None

    def over(work, size: int) -> np.ndarray:
        out = np.zeros(size)
        if small:
            for b in work(iter(local)):
                out += b.column(1).to_numpy()
        else:
            for r in sources.mapInArrow(work, "at int, value double").groupBy("at").agg(F.sum("value")).collect():
                out[r[0]] = r[1]  # one row per place or try
        return out

    g = np.ones(len(names))
    want = [np.array([t.get(k, 0.0) for k in x]) for t, x in zip(targets, (langs, topics))]
    for _ in range(ROUNDS):
        now = over(lambda b, g=g: _places(b, g, power), len(names))
        fitted = rake(now.reshape(len(langs), len(topics)), want).ravel()
        step = np.divide(fitted, now, out=np.ones_like(now), where=now > 0)
        g = g * step
        if np.abs(step - 1).max(initial=0) < CLOSE:
            break
    weighed, budget = max(now.sum(), 1e-300), budget_share * (total or 0)
    scale = (total or 0) / weighed
    low, high = 1e-9 * scale, 1e9 * scale
    for _ in range(5 if total else 0):
        tries = np.geomspace(low, high, 257)
        at = int(np.searchsorted(over(lambda b, x=tries: _kept(b, g, power, x), len(tries)), budget))
        low, high = tries[max(at - 1, 0)], tries[min(at, len(tries) - 1)]
    table = sources.mapInArrow(lambda b: _cells(b, g, power, names, scale, high),
                               "s string, l string, t string, weight double, probability double")
    joined = measured.withColumns(keys).join(F.broadcast(table) if small else table, [  # at most MOST_CELLS rows
        F.col("cell_source") == F.col("s"), F.col("cell_lang") == F.col("l"), F.col("cell_topic") == F.col("t")], "left")
    return _sampled(joined, measured.columns, seed)


def achieved(mixed: DataFrame) -> DataFrame:
    """(axis, value, tokens, wanted, kept): of each source, language and topic its tokens, those its target weight
    gives, and those sampled.  The kept share of the corpus is the sum of kept by that of tokens on one axis."""
    axes = F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.coalesce(c, F.lit(OTHER)).alias("value"))
                               for c in ("source", "lang", "topic")]))
    return mixed.select(axes.alias("x"), "n_tokens", "weight", "sampled").groupBy("x.axis", "x.value").agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("weight")).alias("wanted"),
        F.sum(F.when(F.col("sampled"), F.col("n_tokens")).otherwise(0)).alias("kept"))

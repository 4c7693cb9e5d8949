"""Faults found once: batch borders, measures across texts, patterned words, characters that are no letters."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import language_id, quality, substring_dedup
from demandloom.llm import tokens as T
from demandloom.llm.common import slices


def model():
    full = np.full((2, language_id.SLOTS), 0.2)
    _, slot = language_id.trigrams(pa.array(["and the with of that this"]))
    full[0, slot] += 50
    _, slot = language_id.trigrams(pa.array(["und der mit von das dieser"]))
    full[1, slot] += 50
    return language_id.Model(["de", "en"][::-1], np.log(full / full.sum(axis=1, keepdims=True)))


def batch(texts, first=0):
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(first, first + len(texts)), pa.int64()), "text": pa.array(texts, pa.string()),
        "lang": pa.array([None] * len(texts), pa.string())})


def test_language_stage_across_batch_borders():
    text = ("the and with that " * 250)[:4000]
    two = [batch([text] * 1048), batch([text] * 3, 1048)]
    out = list(language_id._keep(iter(two), model(), 0.3))
    assert sum(b.num_rows for b in out) == 1051
    assert sorted(i for b in out for i in b.column(0).to_pylist()) == list(range(1051))


@pytest.mark.parametrize("run", [language_id._count, lambda b: language_id._keep(b, model(), 0.3)])
def test_language_memory_stays_below_the_batch_times_ten(run):
    whole = batch([f"the {i} and with that und der mit " * 60 for i in range(4000)])  # 8 MB, as Spark sends it
    whole = whole.set_column(2, "lang", pa.array([f"l{i % 3}" for i in range(4000)]))
    tracemalloc.start()
    for _ in run(iter([whole])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 10 * 8_000_000


def test_language_counts_do_not_depend_on_slices(monkeypatch):
    texts = ["the and with", "", "und der", "mit 4 mit", "the", "..", "das und das"] * 9
    whole = batch(texts).set_column(2, "lang", pa.array([f"l{i % 5}" for i in range(len(texts))]))

    def counts():
        out = pa.Table.from_batches(language_id._count(iter([whole])))
        return sorted(zip(*(out.column(c).to_pylist() for c in ("lang", "slot", "n"))))

    want, predicted = counts(), pa.Table.from_batches(language_id._keep(iter([whole]), model(), 0.3)).to_pylist()
    assert sum(n for _, _, n in want) == 9 * sum(b.isalpha() for t in texts[:7] for b in t)
    monkeypatch.setattr(language_id, "SLICE_BYTES", 20)
    assert counts() == want
    assert pa.Table.from_batches(language_id._keep(iter([whole]), model(), 0.3)).to_pylist() == predicted
    assert list(language_id._count(iter([]))) == []


def test_slices_are_not_cut_again():
    rng = np.random.default_rng(1)
    batches = [batch(["x" * int(k) for k in rng.integers(0, 120, 40)] + ["y" * 400] + [""] * 3) for _ in range(20)]
    out = list(slices(iter(batches), 300))
    assert [t for b in out for t in b.column(1).to_pylist()] == [t for b in batches for t in b.column(1).to_pylist()]
    for b in out:
        assert len(list(slices(iter([b]), 300))) == 1
        assert sum(map(len, b.column(1).to_pylist())) <= 300 or sum(map(bool, b.column(1).to_pylist())) == 1


def test_quality_measures_do_not_depend_on_neighbours():
    texts = ["1 2 3 #", "A good text, with words.", "", "§ 4"]
    together = quality.measures(pa.array(texts))
    alone = np.concatenate([quality.measures(pa.array([t])) for t in texts])
    assert (together == alone).all()


def test_only_letters_are_letters():
    texts = ["½", "²³", "①", "12 _", "ñ", "日本", None]
    out = pa.Table.from_batches(language_id._predict(iter([batch(texts)]), model()))
    assert [x == "und" for x in out.column("lang_pred").to_pylist()] == [True, True, True, True, False, False, True]


def patterned(bits):
    """Two words of 2**bits letters: a Thue-Morse pattern and its complement."""
    signs = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)


def test_patterned_words_differ():
    for bits in (3, 7, 10, 12):
        a, b = patterned(bits)
        h = T.scan(pa.array([f"{a} {b} {a}"])).hashes()
        assert h[0] != h[1] and h[0] == h[2]


def test_patterned_words_stay(spark):
    a, b = patterned(10)
    rest = " ".join(f"w{i}" for i in range(49))
    rows = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}")], "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(rows, 50).collect()} == {0}


def test_word_hashes_by_place_and_length():
    words = ["a", "aa", "a" * 8, "a" * 9, "a" * 1024, "a" * 1025, "ab", "ba", "é", "\x00", "\x00\x00"]
    h = T.scan(pa.array([" ".join(words), " ".join(reversed(words))])).hashes()
    assert len(set(h.tolist())) == len(words)
    assert (h[:len(words)] == h[len(words):][::-1]).all()

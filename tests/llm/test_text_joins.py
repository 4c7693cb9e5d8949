"""Substring dedup, n-gram join, components and decontamination on small fixtures."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import components, contraction, decontaminate, ngram_join, packing, substring_dedup
from demandloom.llm import tokens as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, starts string"


def corpus(seed=1, n=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "Ünï", "x\u00a0y", "a\x1cb"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 120, 300]))] for _ in range(n // 4)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(base))
        kind = rng.random()
        if kind < 0.3:
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.5:
            words = words + rng.choice(base)
        elif kind < 0.6:
            words = words * 3
        texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    return [(i, t) for i, t in enumerate(texts)] + [
        (n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "two words")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash") for i, t in rows], SCHEMA)


def removed_by_hand(rows, size):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k:k + size]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("size", [5, 50])
def test_repeats_match_brute_force(spark, size):
    rows = corpus()
    got = substring_dedup.remove_repeats(frame(spark, rows).repartition(5), size)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == removed_by_hand(rows, size)


def test_repeats_across_many_chunks(spark, monkeypatch):
    rows = corpus(2, 60)
    got = substring_dedup.remove_repeats(frame(spark, rows).repartition(30), 10)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == removed_by_hand(rows, 10)


def test_repeats_edges(spark):
    text = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (1, text), (1, text), (2, text)]
    got = sorted((r.doc_id is not None, r.doc_id, r.n_removed) for r in
                 substring_dedup.remove_repeats(frame(spark, rows), 50).collect())
    # The null id is the least; rows of one id fall together.
    assert got == [(False, None, 0), (True, 1, 60), (True, 1, 60), (True, 2, 60)]
    empty = substring_dedup.remove_repeats(frame(spark, []), 50)
    assert empty.collect() == [] and empty.columns[:3] == ["doc_id", "n_words", "n_removed"]


@pytest.mark.parametrize("buckets", [1, 3, 64, 10**12])
def test_filled_buckets_hold_every_value(buckets):
    rng = np.random.default_rng(5)
    values = np.sort(np.append(rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2),
                               np.array([0, 1, (1 << 64) - 1], np.uint64)))
    found = list(packing.filled_buckets(values, buckets))
    assert [f for _, f, _ in found] == [0, *[e for _, _, e in found][:-1]] and found[-1][2] == len(values)
    step = (1 << 64) // buckets
    for b, first, end in found:
        assert end > first and all(min(int(v) // step, buckets - 1) == b for v in values[first:end])
    assert list(packing.filled_buckets(values[:0], buckets)) == []


def test_packed_values_round_trip():
    for values in ([5], [0, 0, 1 << 63, (1 << 64) - 1], list(range(7, 5000, 3))):
        v = np.array(values, np.uint64)
        assert (packing.unpack(packing.pack(v), len(v)) == v).all()


def groups_by_hand(rows, size, similarity):
    sets = {}
    for i, t in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both * similarity.denominator >= similarity.numerator * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size,similarity", [(3, Fraction(9, 10)), (5, Fraction(8, 10)), (1, Fraction(1, 2))])
def test_groups_match_brute_force(spark, size, similarity):
    rows = corpus(3, 90)
    got = ngram_join.similar_groups(frame(spark, rows), size, similarity)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == groups_by_hand(rows, size, similarity)


def test_groups_hot_block_in_tiles(spark, monkeypatch):
    """Variants of one text of which only some link, dealt out as small tiles."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.sample(range(60), 3):
            words[k] = f"n{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(contraction, "TILE", 4)
    got = ngram_join.similar_groups(frame(spark, rows), 1, 0.9)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == groups_by_hand(rows, 1, Fraction(9, 10))


def test_groups_edges(spark):
    assert ngram_join.similar_groups(frame(spark, []), 3, 0.9).collect() == []
    got = ngram_join.similar_groups(frame(spark, [(None, "a b c d"), (4, "A b C d"), (4, "a b c d"), (5, None)]), 3, 0.9)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got.collect()) == [
        ("4", "None"), ("4", "None"), ("5", "5"), ("None", "None")]


def test_parts_share_a_key_if_linked():
    """Random linked pairs have a part in common, whatever their sizes."""
    rng = np.random.default_rng(0)
    s = Fraction(9, 10)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = a.copy()
        for k in rng.integers(0, n, n // 19):
            b[k] = rng.integers(0, 1 << 63)
        if rng.random() < 0.5:
            b = b[:max(1, int(n * 0.96))]
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if both * 10 < 9 * (len(a) + len(b) - both):
            continue
        doc = np.repeat([0, 1], [len(a), len(b)])
        owner, keys = ngram_join.part_keys(doc, np.concatenate([a, b]), np.array([len(a), len(b)]), s)
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@pytest.mark.parametrize("size", [3, 12, 60, 400, 2000])
def test_sets_that_share_nothing_share_no_block(size):
    rng = np.random.default_rng(size)
    n = 200
    doc = np.repeat(np.arange(n), size)
    value = rng.integers(0, 1 << 63, n * size, dtype=np.uint64)
    owner, keys = ngram_join.part_keys(doc, value, np.full(n, size), Fraction(8, 10))
    assert len(np.unique(keys)) == len(keys) >= n and set(owner) == set(range(n))


@pytest.mark.parametrize("s", [Fraction(8, 10), Fraction(85, 100), Fraction(9, 10)])
def test_linked_sets_share_a_block(s):
    rng = np.random.default_rng(3)
    for size in [1, 2, 3, 4, 5, 9, 10, 11, 20, 33, 100, 1000]:
        for _ in range(6):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            # The smallest overlap that links a with a set of the same, and of a smaller, size.
            same = -(-2 * size * s.numerator // (s.numerator + s.denominator))
            less = -(-size * s.numerator // s.denominator)
            for shared, more in ((same, size - same), (less, 0)):
                b = np.concatenate([rng.permutation(a)[:shared], rng.integers(0, 1 << 63, more, dtype=np.uint64)])
                doc = np.repeat([0, 1], [len(a), len(b)])
                owner, keys = ngram_join.part_keys(doc, np.concatenate([a, b]), np.array([len(a), len(b)]), s)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_rtree_loses_no_pair():
    rng = np.random.default_rng(1)
    points = rng.poisson(3, (120, ngram_join.GROUPS))
    points[60:] = points[:60] + (rng.random((60, ngram_join.GROUPS)) < 0.03)
    sizes, s = points.sum(axis=1), Fraction(9, 10)
    found = {tuple(sorted(p)) for i, j in ngram_join.rtree_pairs(points, sizes, np.full(120, 2), s)
             for p in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(120) for j in range(i + 1, 120)
            if ngram_join.enough(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j], s)}
    assert found == want and want


@pytest.mark.parametrize("small", [0, 1 << 10])
def test_a_pair_leaves_one_of_its_blocks(monkeypatch, small):
    """Near copies share most of their parts; each pair leaves one block, by the R-tree and without it."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rng = np.random.default_rng(5)
    sets = np.tile(rng.integers(0, 1 << 63, 120, dtype=np.uint64), (24, 1))
    for row in sets:
        row[rng.permutation(120)[:6]] = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    doc, s = np.repeat(np.arange(24), 120), Fraction(8, 10)
    owner, key = T.distinct(*ngram_join.part_keys(doc, sets.ravel(), np.full(24, 120), s))
    key = key.view(np.int64)
    points = ngram_join.set_points(doc, sets.ravel(), 24).to_pylist()
    left, shared = [], 0
    for block in np.unique(key):
        ids = owner[key == block]
        if len(ids) < 2:
            continue
        shared += len(ids) * (len(ids) - 1) // 2
        least = [np.sort(key[owner == i])[:16].tolist() for i in ids]
        full = lambda v: pa.array(np.full(len(ids), v))
        table = pa.table({"id": ids, "block": full(block), "comp": ids, "t0": full(0), "t1": full(0), "side": full(2),
                          "n": full(120), "point": [points[i] for i in ids],
                          "blocks": pa.array(least, pa.list_(pa.int64()))})
        found = ngram_join._tile_pairs(table, s)
        left += zip(found["a"].to_pylist(), found["b"].to_pylist())
    assert set(left) == {(a, b) for a in range(24) for b in range(a + 1, 24)}
    assert len(left) <= 1.2 * len(set(left)) < shared / 10


@pytest.mark.parametrize("most", [1, 3, 100])
def test_first_here_loses_no_pair(most):
    """Every pair stays in the least block that it shares; with all blocks of its members known, nowhere else."""
    rng = np.random.default_rng(most)
    has = [np.sort(rng.permutation(np.arange(-20, 20))[:rng.integers(0, 40)]) for _ in range(40)]
    rows = contraction.block_rows(pa.array([h[:most].tolist() for h in has], pa.list_(pa.int64())))
    for i in range(40):
        for j in range(i):
            shared = np.intersect1d(has[i], has[j])
            k = np.full(len(shared), i), np.full(len(shared), j)
            kept = shared[contraction.first_here(shared, rows[k[0]], rows[k[1]])]
            assert list(kept[:1]) == list(shared[:1]) and (most < 100 or len(kept) <= 1)


def test_blocks_of_the_same_members_are_one(spark):
    rows = [(7, 1, 1), (7, 2, 2), (8, 1, 1), (8, 2, 2), (9, 1, 1), (9, 3, 3), (10, 1, 1), (10, 4, 1)]
    placed = spark.createDataFrame(rows, "block long, id long, comp long")
    got = lambda alike: sorted((r.block, r.id) for r in contraction._open(placed, alike).collect())
    assert got(True) == [(7, 1), (7, 2), (9, 1), (9, 3)]
    assert got(False) == [(7, 1), (7, 2), (8, 1), (8, 2), (9, 1), (9, 3)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 50), (60, 60), (41, 50), (100, 3)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in [*range(21), 100]} | {40: 40, 41: 40, 50: 40}
    assert {r.node: r.component for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_best_passage_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(40):
        item, text = rng.integers(0, 6, 7).astype(np.uint64), rng.integers(0, 6, 14).astype(np.uint64)
        want = min(levenshtein(item, text[i:j]) for i in range(15) for j in range(i, 15))
        assert decontaminate.best_passage(item, text)[0] == want


def test_benchmark_items_are_found(spark):
    """Whole and edited items at any place; texts without them stay clean."""
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 60)))) for i in range(40)]
    rows, want = [], set()
    for d in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 200))]
        if d % 2:
            i, text = items[d % 40]
            part = text.split()
            for _ in range(rng.randint(0, decontaminate.allowed(len(part), 0.8))):
                k, kind = rng.randrange(len(part)), rng.random()
                if kind < 0.4:
                    part[k] = rng.choice(vocabulary)
                elif kind < 0.7 and len(part) > 1:
                    del part[k]
                else:
                    part.insert(k, rng.choice(vocabulary))
            at = rng.randint(0, len(words))
            words[at:at] = part
            want.add((d, i))
        rows.append((d, ", ".join(words).upper() if d % 3 == 0 else "\n".join(words)))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items] + [(98, None, "x"), (99, "too short", "x")],
                                  "item_id long, text string, lang string")
    docs = frame(spark, rows + [(1000, None), (1001, "")])
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
    left = {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got} | {1000, 1001}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0


def test_long_items_beside_short_ones_are_found(spark):
    """Every passage with the allowed number of edits is found, whatever the lengths of the other items."""
    rng = random.Random(8)
    word = lambda: f"t{rng.randrange(5000)}"
    items = [(i, [word() for _ in range(8 if i < 70 else 15 if i < 80 else 60 if i < 90 else 120)]) for i in range(100)]
    rows, want = [], set()
    for d in range(600):
        i, part = items[d % 100][0], list(items[d % 100][1])
        for _ in range(decontaminate.allowed(len(part), 0.8)):
            k, kind = rng.randrange(len(part)), rng.randrange(3)
            part[k:k + (kind < 2)] = [word()] if kind else []
        rows.append((d, " ".join([word() for _ in range(rng.randrange(90))] + part + [word() for _ in range(50)])))
        want.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    assert got == want


@pytest.mark.parametrize("similarity", [0.8, 0.6])
def test_benchmark_items_match_brute_force(spark, similarity):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(4)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(6, 15))]) for i in range(12)]
    rows = [(d, [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]) for d in range(60)]
    number = {v: i for i, v in enumerate(vocabulary)}
    coded = lambda w: np.array([number[x] for x in w], np.int64)
    want = {(d, i): best for d, w in rows for i, x in items
            if (best := decontaminate.best_passage(coded(x), coded(w))[0]) <= decontaminate.allowed(len(x), similarity)}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    docs = frame(spark, [(d, " ".join(w)) for d, w in rows])
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(docs, bench, similarity=similarity).collect()}
    assert got == want and got


@pytest.mark.parametrize("m", [6, 8, 15, 38, 60, 120, 200])
def test_tables_reach_the_recall_of_their_length(m):
    """New edited copies, at the most edits, in item-sized windows without a shift."""
    rng = np.random.default_rng(m + 77)
    items = [rng.integers(1, 1 << 62, m).astype(np.uint64) for _ in range(8)]
    sampled, tables = decontaminate.tables_needed(items, 0.8, 1.0)
    if not tables:
        assert m > 100  # every place is verified
        return
    other = [rng.integers(1, 1 << 62, m).astype(np.uint64) for _ in range(8)]
    copies = np.concatenate([decontaminate.edited(x, decontaminate.allowed(m, 0.8), 250, rng) for x in other])
    keys = np.repeat(decontaminate.table_keys(np.stack(other), sampled, tables), 250, axis=1)
    assert (decontaminate.table_keys(copies, sampled, tables) == keys).any(axis=0).mean() >= 0.99


def test_short_and_unspaced_items_are_found(spark):
    story = "昔々ある所にお爺さんとお婆さんが住んでいましたお爺さんは山へ柴刈りに"
    bench = spark.createDataFrame([(1, story), (2, "Quick brown fox"), (3, "Zyzzyva"), (4, " .,; "), (5, "")],
                                  "item_id long, text string")
    rows = [(1, "前書き。" + story + "続き"), (2, story[:10] + "川" + story[11:]), (3, "a quick, BROWN fox!"),
            (4, "quick brown dog"), (5, "zyzzyva"), (6, story[:12]), (7, "zyzzyvas")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (5, 3)}


def test_cgk_keeps_equal_sequences_and_prefixes():
    x = np.arange(1, 31, dtype=np.uint64)[None, :]
    y = x.copy()
    y[0, 20] = 99
    a, b = decontaminate.cgk(x, 0)[0], decontaminate.cgk(y, 0)[0]
    assert (decontaminate.cgk(x, 0)[0] == a).all() and (a == b).mean() > 0.5


def test_words_match_the_pattern():
    texts = ["", " a\u00a0b  c\n", "\x1c\x85 d", "É\x0bé", "x"]
    w = T.scan(pa.array(texts))
    got = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert got == [x for t in texts for x in WORD.findall(t)]
    assert w.counts.tolist() == [len(WORD.findall(t)) for t in texts]


def test_pipeline_stages_with_null_and_repeated_ids(spark):
    """One row of each group stays, and each row is cut and judged by its own text."""
    import corpus_pipeline as P

    text = lambda c, n=60: " ".join(f"{c}{i}" for i in range(n))
    rows = [(None, text("a")), (3, text("a")), (4, text("a") + " x"),  # a group with a null id
            (None, text("b")), (None, text("c")), (None, None), (None, ""),  # null ids, not linked
            (5, text("d")), (5, text("d")), (5, text("e")), (6, text("e")), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = P.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted([
        (None, text("a")), (None, text("b")), (None, text("c")), (None, None), (None, ""), (5, text("d")),
        (5, text("e")), (7, None), (8, "")], key=key)

    rows = [(None, text("a") + " tail"), (1, "head " + text("a")), (2, text("b")), (2, text("b")), (2, text("c") + " z"),
            (3, text("c") + " y"), (4, text("b")), (None, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], docs.schema)
    got = P.cut_repeats(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in got.collect()), key=key) == sorted([
        (None, text("a") + " tail", len(text("a")) + 5), (1, "head", 4), (2, text("b"), len(text("b"))),
        (2, text("b"), len(text("b"))), (2, text("c") + " z", len(text("c")) + 2), (3, "y", 1), (None, None, None),
        (5, "", 0)], key=key)
    two = spark.createDataFrame([(None, text("a") + " p", "en", "s", 1), (None, text("a") + " q", "en", "s", 1)], docs.schema)
    assert sorted(len(r.text.split()) for r in P.cut_repeats(spark, two, "").collect()) == [1, 61]

    bench = spark.createDataFrame([(1, text("a", 20))], "item_id long, text string")
    docs = spark.createDataFrame([(None, text("a", 30)), (None, text("b")), (1, text("a")), (1, text("c"))],
                                 "doc_id long, text string")
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {(r.doc_id, r.text) for r in left.collect()} == {(None, text("b")), (1, text("c"))}

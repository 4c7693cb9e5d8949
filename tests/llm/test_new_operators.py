"""Phrases, Merkle manifest and MinHash groups against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandloom.llm import collocations, contraction, decontaminate, merkle, minhash
from tests.llm.test_text_joins import corpus, frame, groups_by_hand

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, chunk string, pos int, block string"


def phrases_by_hand(rows, support, longest, most):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, found in counts.items():
        good = {p: a for p, a in found.items() if a >= support}
        ranked = []
        for p, a in good.items():
            longer = max((b for q, b in good.items() if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))), default=0)
            if len(p) == 1 or 100 * longer >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]])
                                 for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:most])]
    return sorted(out)


def phrase_rows(seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "new", "york", "City", "été", "a b", "x_1", "<de>"] + [f"w{i}" for i in range(40)]
    passage = "New York city of the seven (7) hills"
    rows = []
    for i in range(120):
        words = [rng.choice(vocabulary[:9] if rng.random() < 0.5 else vocabulary) for _ in range(rng.choice([1, 5, 60]))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ? "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None, "a b"]), text + (passage if i % 3 else "")))
    return rows + [("en", None), ("en", ""), (None, " .,; \n"), ("xx", "one"), ("en", "the " * 500)]


@pytest.mark.parametrize("chunk", [8 << 20, 700])
def test_phrases_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 2000)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, "s", g, 1, t, "c", 1, "b") for i, (g, t) in enumerate(rows)], SCHEMA).repartition(3)
    for support, most in ((5, 40), (12, 2000)):
        got = sorted(tuple(r) for r in collocations.collocations(docs, support, 5, most, chunk_bytes=chunk).collect())
        assert got == phrases_by_hand(rows, support, 5, most)
    empty = collocations.collocations(docs.limit(0), 5)
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_only_frequent_phrases_leave_chunks_and_each_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 2000)
    # Every chunk has its own phrase 30 times, and all share one: 40 chunks, one string for the shared phrase.
    rows = [("en", " . ".join([f"own{i // 30} own{i // 30}x", "new york city"])) for i in range(1200)]
    docs = spark.createDataFrame([(i, "s", g, 1, t, "c", 1, "b") for i, (g, t) in enumerate(rows)], SCHEMA).coalesce(2)
    _, _, frequent = collocations._frequent_counts(docs, 100, 5, "lang", "text", 900)
    assert sorted(tuple(r) for r in frequent.collect()) == [
        ("en", "new york", 2, 1200), ("en", "new york city", 3, 1200), ("en", "york city", 2, 1200)]


def test_equal_first_hashes_are_told_apart():
    packed = lambda chunk, check: {"bucket": 0, "chunk": chunk, "hashes": collocations.pack(np.array([7, 7, 9], np.uint64)),
                                   "checks": np.array(check, np.uint64).tobytes(), "counts": bytes([60, 50, 1]), "n": 3}
    table = pa.Table.from_pylist([packed(1, [1, 2, 3]), packed(2, [1, 5, 3])], collocations._PACKED)
    asked = collocations._ask(table, 100).to_pylist()
    assert [(r["places"], r["totals"]) for r in asked] == [(bytes(4), (120).to_bytes(8, "little"))]


def test_pieces_end_with_texts():
    codes, words, first, times = collocations.encode(pa.array(["", "a b", "", "b.c", " ", "d"]))
    names = [bytes(words.data[words.start[i]:words.end[i]]).decode() for i in first]
    assert [None if c == collocations.GAP else names[c] for c in codes] == ["a", "b", None, "b", None, "c", None, "d"]
    assert times.sum() == 5


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def manifest_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text); their order decides ties of ids by leaf."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaf = lambda r: sha(*map(enc, r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, at):
        for nodes in levels[:-1]:
            first = at // 16 * 16
            yield nodes[first:at], nodes[at + 1:first + 16]
            at //= 16

    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            changed = r[0] is not None and __import__("zlib").crc32(str(r[0]).encode()) % 5 == 0
            node, proof = leaf((*r[:4], lower(r[4])) if changed else r), ""
            for left, right in [*path(trees[s], i), *path(top, k)]:
                proof += "".join(left + right)
                node = sha(*left, node, *right)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("deep", [1, 3])
def test_manifest_matches_brute_force(spark, deep):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 else rng.choice([None, "", "é", "-", "1:a", *[f"s{k}" for k in range(30)]]),
             rng.choice([None, "en"]), rng.choice([None, 5, -1]), rng.choice([None, "", "Ab é ÀB", "abc", "x" * 3000]))
            for i in rng.sample(range(10_000), 900)]
    rows += [(None, "hot", "en", 1, "A"), (None, None, None, None, None), (7, "lone", "de", 2, "Text")]
    rows += [rows[0]] * 40 + [(rows[1][0], rows[1][1], "fr", 3, "Other")]
    docs = spark.createDataFrame([(*r, "c", 1, "b") for r in rows], SCHEMA).repartition(7)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = [tuple(r) for r in merkle.manifest(docs, tampered, deep=deep).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(manifest_by_hand(rows), key=key)


def test_manifest_edges(spark):
    docs = spark.createDataFrame([(1, "a", "en", 1, "T", "c", 1, "b")], SCHEMA)
    r = merkle.manifest(docs).first()
    assert r.root == r.subroot == r.leaf == sha("1:1", "1:a", "2:en", "1:1", "1:T") and r.verified
    assert r.proof_sha256 == sha("")
    assert merkle.manifest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("size, similarity", [(5, Fraction(85, 100)), (3, Fraction(9, 10))])
def test_minhash_groups_match_brute_force(spark, monkeypatch, size, similarity):
    monkeypatch.setattr(contraction, "TILE", 4)
    monkeypatch.setattr(contraction, "WORK_ROWS", 50)
    rows = corpus(5, 120)
    got = minhash.near_duplicates(frame(spark, rows).repartition(4), size, similarity).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups_by_hand(rows, size, similarity)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_edges(spark):
    text = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (4, text), (4, text), (9, text + " more"), (5, None), (6, ""), (7, "a b"), (8, "A  b")]
    got = sorted(((r.doc_id is not None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in
                  minhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == sorted([
        (False, None, 56, None, True), (True, 4, 56, None, False), (True, 4, 56, None, False),
        (True, 9, 57, None, False), (True, 5, 0, 5, True), (True, 6, 0, 6, True), (True, 7, 1, 7, True),
        (True, 8, 1, 7, False)], key=str)
    assert minhash.near_duplicates(frame(spark, [])).collect() == []


def test_stages_with_clashing_columns(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(n))
    shared = words(60)
    texts = [words(80), shared + " " + words(90), words(90) + " " + shared, words(40)]
    names = ["row_key", "own_id", "starts", "mark", "kept_key", "found_key", "n_removed", "row_id", "ends", "of", "key"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
                                     f"{n} string" for n in names))
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    cut = corpus_pipeline.cut_repeats(spark, docs, "")
    items = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    clean = decontaminate.decontaminate(docs, items)
    for out, n in ((kept, 4), (cut, 4), (clean, 3)):
        rows = out.collect()
        assert out.columns == docs.columns and len(rows) == n
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
    assert {r.doc_id for r in cut.collect() if r.n_chars < len(texts[r.doc_id])} == {2}

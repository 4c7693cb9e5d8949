"""Top-k, mixing, quality, URL filter, HTML, language and token operators."""

import glob
import math
import os
import random
import re

import numpy as np
import pytest

from demandloom.llm import html_text, language_id, mixing, quality, queries, token_counts, topk_search, url_filter

ROOT = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


# -- top-k ---------------------------------------------------------------------


def brute_top(rows, asked, k):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
               if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, qv in vectors:
        if asked(q):
            hits = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in vectors if i != q and len(v) == len(qv)]
            out[q] = [(i, -s) for s, i in sorted(hits)[:k]]
    return out


@pytest.mark.parametrize("width", [1, 7, 32])
def test_top_k_matches_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(topk_search, "STEP", 16)
    monkeypatch.setattr(topk_search, "STRIPE", 64)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 5)
    rng = random.Random(width)
    rows = [(i, [rng.choice([-1.0, 0.25, rng.uniform(-2, 2)]) for _ in range(width)]) for i in range(200)]
    rows[5] = (5, rows[6][1])
    rows += [(300, None), (301, [None] * width), (302, [float("nan")] * width), (303, [float("inf")] * width)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    whole = topk_search.whole_vectors(df)
    got = {}
    for r in topk_search.top_k(whole, whole.where("vec_id % 20 = 0"), 9).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    import struct
    single = [(i, v and [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    assert got == brute_top(single, lambda q: q % 20 == 0, 9)


def test_top_k_edges(spark):
    empty = topk_search.whole_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk_search.top_k(empty, empty).collect() == []
    two = topk_search.whole_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [])],
                                                          "vec_id long, embedding array<float>"))
    assert sorted((r.query_id, r.vec_id, r.score) for r in topk_search.top_k(two, two, 5).collect()) == [
        (0, 1, 64 * 128), (1, 0, 64 * 128)]


def test_segment_bounds_hold():
    rng = np.random.default_rng(0)
    q, v = rng.normal(size=(50, 30)), rng.normal(size=(60, 30))
    true = q @ v.T
    coarse = topk_search.segment_statistics(q, 3) @ topk_search.segment_statistics(v, 3).T
    fine = topk_search.segment_statistics(q, 15) @ topk_search.segment_statistics(v, 15).T
    assert (coarse >= true - 1e-9).all() and (fine >= true - 1e-9).all() and fine.sum() < coarse.sum()


# -- mixing --------------------------------------------------------------------


def test_rake_reaches_the_marginals():
    rng = np.random.default_rng(1)
    cells = rng.random((4, 3, 5)) + 0.1
    targets = [np.array(x) / sum(x) for x in ([1, 2, 3, 4], [5, 1, 1], [1, 1, 1, 1, 4])]
    fitted = mixing.rake(cells, targets)
    for axis, t in enumerate(targets):
        rest = tuple(a for a in range(3) if a != axis)
        assert np.allclose(fitted.sum(axis=rest) / fitted.sum(), t, atol=1e-6)
    # Raking keeps the odds ratios of the cells.
    odds = lambda c: c[0, 0, 0] * c[1, 1, 0] / (c[0, 1, 0] * c[1, 0, 0])
    assert np.isclose(odds(fitted), odds(cells))


def test_mix_samples_by_cell(spark):
    rows = [(i, "word " * 10, f"s{i % 3 and 1}", ["en", None][i % 2], "clash") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, weight string")
    measured = mixing.measure(docs)
    assert {r.topic for r in measured.select("topic").distinct().collect()} == {"repeats"}
    out = mixing.mix(measured, {"s0": 0.5, "s1": 0.5}, {"en": 0.5, mixing.OTHER: 0.5}, {"repeats": 1.0}).collect()
    assert len(out) == 3000
    kept = {s: sum(r.sampled for r in out if r.source == s) for s in ("s0", "s1")}
    assert kept["s0"] == 1000 and 400 < kept["s1"] * 1.0 < 1100  # s1 has twice the tokens, half are wanted
    weighted = {s: sum(r.weight * r.n_tokens for r in out if r.source == s) for s in ("s0", "s1")}
    assert math.isclose(weighted["s0"], weighted["s1"], rel_tol=1e-6)
    half = mixing.mix(measured, {"s0": 0.5, "s1": 0.5}, {"en": 0.5, mixing.OTHER: 0.5}, {"repeats": 1.0}, budget_share=0.2)
    expected = sum(r.probability * r.n_tokens for r in half.collect())
    assert math.isclose(expected, 0.2 * 30000, rel_tol=1e-6)


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string, lang string"
    empty = mixing.measure(spark.createDataFrame([], schema))
    assert mixing.mix(empty, {}, {}, {}).collect() == [] and mixing.shares(empty, "source") == {}
    odd = mixing.measure(spark.createDataFrame([(None, None, None, None), (1, "", "a", "b"), (1, "", "a", "b")], schema))
    out = mixing.mix(odd, {"a": 1}, {"b": 1}, {"blank": 1}).collect()
    assert [(r.n_tokens, r.sampled) for r in out] == [(0, False)] * 3


@pytest.mark.parametrize("most", [200_000, 0])
def test_mix_all_keeps_half_beside_scarce_cells(spark, monkeypatch, most):
    """All of many sources have their own target; a scarce one does not set the rate of the corpus."""
    monkeypatch.setattr(mixing, "MOST_CELLS", most)
    monkeypatch.setattr(mixing, "ROUNDS", 12)
    rows = [(i, "s%d" % (i % 300), ["en", "de"][i % 7 > 4], "prose", 100 + i % 3) for i in range(6000)]
    rows += [(6000, "rare", "xx", "prose", 1), (None, "s1", "en", "prose", 100), (None, "s1", None, None, 101),
             (7000, None, "en", "table", 5), (7001, "s1", "en", "prose", 0)]
    measured = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    mixed = mixing.mix_all(measured)
    assert mixed.columns == [*measured.columns, "weight", "probability", "sampled"]
    out = mixed.collect()
    total = sum(r.n_tokens for r in out)
    assert len(out) == len(rows)
    assert math.isclose(sum(r.probability * r.n_tokens for r in out), total / 2, rel_tol=1e-6)
    assert [r.sampled for r in out if r.source == "rare"] == [True]
    shares = {}
    for r in out:
        shares[r.source] = shares.get(r.source, 0) + r.weight * r.n_tokens / total
    assert 0.8 < shares["s299"] / shares["s0"] < 1.25 and len(shares) == 302
    kept = {r.value: r.kept / r.tokens for r in mixing.achieved(mixed).where("axis = 'lang'").collect()}
    assert 0.4 < kept["en"] < 0.6 and kept["xx"] == 1.0
    assert mixing.mix_all(measured.limit(0)).collect() == []


# -- quality -------------------------------------------------------------------


@tables
def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op5_quality_classifier(spark, ROOT).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    held = [(got[d].score, q) for d, q in labels.items() if got[d].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum((s >= 0.3) == bool(q) for s, q in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "a b\nc", "c"), (None, "x " * 20000, "c")],
                                 "doc_id long, text string, score string")
    measured = quality.measure(docs)
    none = spark.createDataFrame([], "doc_id long, quality int")
    scorer = quality.train(measured, none, measured["doc_id"] > 0)
    rows = quality.score(measured, scorer).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(quality.measure(docs.limit(0)), scorer).collect() == []


def test_risk_keeps_unlabelled_positives():
    """Half of the unlabelled rows are like the positives: they score high, the others low."""
    rng = np.random.default_rng(0)
    width = len(quality.MEASURES)
    good, bad = rng.normal(1, 1, (3000, width)), rng.normal(-1, 1, (1500, width))
    scorer = quality.fit(good[:1500], np.concatenate([good[1500:], bad]), prior=0.5)
    assert (scorer.scores(good[1500:]) > 0.5).mean() > 0.95 and (scorer.scores(bad) < 0.5).mean() > 0.95


# -- URLs ----------------------------------------------------------------------


def rule_by_hand(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m.group(2)), m.group(3)) if m else ("", "")
    fits = [(len(r), r, v) for v, r in queries.URL_RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules_and_trees(spark):
    urls = [None, "", "no scheme", "http://", "https://A.EXAMPLE.org/es/x?q=/en/1", "ftp://example.org/en/12#a",
            "http://example.org", "http://org/", "http://xorg/", "http://a.com/fr/é?x=1&y=2", "http://com/de/",
            "http://b.com/de", "http://c.net/fr/://d.org/", "x://y.com\n/fr/", "http://example.org/en/2",
            "http://a.com/de/" + "9" * 5000]
    rng = random.Random(0)
    urls += [f"http://h{rng.randrange(9)}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['fr', 'de', 'en'])}/{i}"
             for i in range(300)]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = rule_by_hand(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    one = url_filter.filter_urls(pages.where("page_id = 7"), queries.URL_RULES).collect()
    assert [(r.rule, r.verdict) for r in one] == [("org/", "allow")]
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).collect() == []


def test_url_trees_learn_lexical_signs(spark):
    rows = [(i, f"http://a.org/d{i}") for i in range(100)] + [(100 + i, f"http://bad.org/x?u={i}&v=123456789") for i in range(100)]
    rows += [(200, "http://c.net/x?u=7&v=123456789"), (201, "http://c.net/d7")]
    rules = (("allow", "org/"), ("block", "bad.org/"))
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(
        spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert (got[200], got[201]) == ("block", "allow")


# -- HTML ----------------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><article>";</script></head>
<body class="home"><header><a href=/>Home</a></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">Cookies!</div>
<{open}><h1>Title &amp; more</h1><p>First <b>bold</b>ly &eacute; &#x41;<br>next  line
tab<p>Second paragraph which is long enough to count as text, &lt;really&gt;.<div class="ad-box">Buy {n}</div>
<ul><li>item one<li>item two</ul><form><input>Send</form><script>x<y</script><!-- <p>no</p> -->
<section id=comments><p>Reader says hello to everyone and this is long.</section></{close}>
<aside><p>Related stuff that is rather long, longer than others, yes it is long.</p></aside><footer>&copy; x</footer></body></html>"""
TEXT = ("Title & more First boldly é A next line tab Second paragraph which is long enough to count as text, <really>. "
        "item one item two")


def test_main_text_by_host_path(spark):
    rows = [(i, f"http://h{i % 2}.x/{i}", PAGE.format(n=i, open='div class="post post-7 x"' if i % 2 else "article",
                                                     close="div" if i % 2 else "article"), "c") for i in range(10)]
    rows += [(90, None, None, "c"), (91, "bad", "", "c"), (92, "http://h0.x/", "plain text &amp", "c"),
             (93, "http://h0.x/", "<p>only <i>this</i><p>and that", "c"), (94, "http://h0.x/", "<a <b>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    assert all(got[i].text == TEXT and got[i].n_chars == len(TEXT) for i in range(10))
    assert (got[90].text, got[91].text, got[90].n_chars) == ("", "", 0)
    assert got[92].text == "plain text &" and got[93].text == "only this and that"
    assert html_text.main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("page", [
    "<html class='no-cookie'><body class='has-sidebar'>{}</body></html>", "<body id='search-page'>{}</body>",
    "<body><div data-id='ad-5'>{}</div></body>", "<body><div style='overflow:hidden' title='class=ad'>{}</div></body>",
    "<body><form action=/x id=aspnetForm>{}</form></body>", "<body><div class='layout-widget'>{}</div></body>",
    "<body><div class='sidebar-page'><div id=cookies>{}</div></div></body>", "<body><div class=with-comments>{}</div></body>",
    "<body><p>Home</p><div class='widget a'>{}</div></body>"])
def test_loose_marks_do_not_empty_a_page(page):
    text = "A paragraph which is long enough to count as text of the article."
    parts = (f"<div class=text><p>{text}</p><p>{text}</p></div><div class='ad-box'>Buy</div>"
             "<section id=comments><p>Reader says hello to everyone and this is long.</p></section><div hidden>x</div>")
    assert html_text.Page(page.format(parts)).extract(None) == f"{text} {text}"


LONG, LEAD = "The long body of the article has many sentences that count. " * 9, "A lead of some length opens the page here."
FRAME = ("<body><header><a href=/>Home</a> Site</header><nav><a href=/>Menu</a></nav>{}<div class=more><a href=/a>{}</a>"
         "</div><aside>Aside</aside><footer>Imprint</footer></body>").format("{}", "Another page that is linked from here. " * 3)


@pytest.mark.parametrize("page, want", [
    ("<article><h1>Title</h1><p>{lead}</p><div class=body>{long}</div></article>", "Title {lead} {long}"),
    ("<article><h1>Title</h1><p>{lead}</p><div class=ad>Buy</div><div class=body>{long}</div></article>", "Title {lead} {long}"),
    ("<div class=intro><p>{lead}</p></div><div class=text><p>{long}</p></div>", "{lead} {long}"),
    ("<div id=w><h1>Title</h1><div class=a><div class=b><div><p>{lead}</p></div><div><div><p>{long}</p></div></div></div>"
     "</div></div>", "Title {lead} {long}")])
def test_whole_articles_of_nested_and_split_layouts(page, want):
    want = " ".join(want.format(lead=LEAD, long=LONG).split())
    one = html_text.Page(FRAME.format(page.format(lead=LEAD, long=LONG)))
    assert one.extract(None) == want and one.extract([one.paths[one.best()[0]]]) == want


def test_hosts_with_two_templates(spark):
    """The second template has an element at the first one's path, too."""
    first = FRAME.format(f"<div class=main><p>{LONG}</p></div>")
    second = FRAME.format(f"<div class=main><p>{LEAD}</p></div><div class=story><p>{LONG}</p></div>")
    rows = [(i, "http://h.x/", second if i % 5 == 0 else first) for i in range(40)]
    got = {r.page_id: r.text for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == (f"{LEAD} {LONG}" if i % 5 == 0 else LONG).strip() for i in range(40))
    assert len(html_text.winning_paths(spark.createDataFrame(rows, "page_id long, url string, html string")).first().paths) == 2


# -- language ------------------------------------------------------------------


@tables
def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op8_language_id(spark, ROOT).collect()}
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").collect()
    held = [(d.lang, got[d.doc_id].lang_pred) for d in docs if got[d.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.99 * len(held)


@tables
def test_language_mixtures_and_edges(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    model = language_id.learn(docs)
    text = {lang: docs.where(f"lang = '{lang}' and n_chars between 2000 and 2600").first().text for lang in ("en", "de")}
    rows = [(1, text["en"] + " " + text["de"]), (2, None), (3, ""), (4, "123 $$ 9"), (5, text["de"] * 200), (6, text["de"] * 200)]
    got = {r.doc_id: r for r in language_id.identify(
        spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int"), model).collect()}
    assert set(got[1].languages) == {"en", "de"} and all(0.3 < s < 0.7 for s in got[1].shares)
    assert [(got[i].lang_pred, got[i].score) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert got[5].lang_pred == got[6].lang_pred == "de"
    empty = docs.limit(0)
    assert language_id.identify(empty, model).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs.limit(5), language_id.learn(empty)).collect()} == {"und"}


# -- tokens --------------------------------------------------------------------


def test_token_counts_match_the_tokenizer(spark, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    rng = random.Random(0)
    odd = ["don't", "It's", "naïve\u00a0x", "e\u0301te\u0301", "<|endoftext|>", "a<|startoftext|>b<|x", "12345", "ſß", "ΑΣ", "日本語",
           "a\x1cb", "c\x85d", "\u2003", "👍🏽", "x" * 3000, "'s", "İ", "\u0301"]
    texts = [None, "", " \n", *odd] + [" ".join(rng.choice([*odd, f"word{rng.randrange(900)}"]) for _ in range(60))
                                       for _ in range(60)]
    docs = spark.createDataFrame([(i % 70, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    want = sorted((i % 70, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False)))
                  for i, t in enumerate(texts))
    for most in (token_counts.FREQUENT, 8, 0):
        monkeypatch.setattr(token_counts, "FREQUENT", most)
        got = token_counts.count_tokens(docs, path).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(docs.limit(0), path).collect() == []


# -- queries against SQL, and the pipeline --------------------------------------


@tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    import duckdb

    from tools_check import rows

    con = duckdb.connect()
    for p in glob.glob(f"{ROOT}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.queries()[name](spark, ROOT)
    cur = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names) and rows(df.columns, df.collect()) == rows(names, cur.fetchall())


@tables
def test_pipeline_stages(spark, tmp_path):
    """Every stage gives the columns of documents and what its decision says."""
    import corpus_pipeline as P
    from tests.llm.test_text_joins import groups_by_hand, removed_by_hand
    from fractions import Fraction

    docs = spark.read.parquet(f"{ROOT}/documents.parquet").where("n_chars < 20000")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    for name, step in P.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = step(spark, docs, ROOT)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "mixing":
            assert 0 < len(after) < len(before)
            break
        assert docs.columns == columns
        rows = [(i, r.text) for i, r in before.items()]
        if name == "language_id":
            assert len(after) == len(before)
        elif name == "ngram_jaccard_join":
            assert set(after) == {i for i, (_, c) in groups_by_hand(rows, 5, Fraction(8, 10)).items() if i == c}
        elif name == "substring_dedup":
            want = removed_by_hand(rows, 50)
            assert set(after) == {i for i, (n, gone, _) in want.items() if gone == 0 or gone < n}
            assert all((after[i].text == before[i].text) == (want[i][1] == 0) for i in after)
            assert all(after[i].n_chars == len(after[i].text) for i in after)
        elif name == "decontamination":
            assert not any(t in r.text for r in after.values() for _, t in bench)
            assert all(any(t[:25] in r.text for _, t in bench) for i, r in before.items() if i not in after)

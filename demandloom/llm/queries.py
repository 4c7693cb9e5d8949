"""Registered queries of the training-data operators, and their SQL for DuckDB.

Each query runs its operator over its whole table; the columns named in its
contract come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import (
    collocations, decontaminate, html_text, language_id, merkle, minhash, mixing, ngram_join, quality, substring_dedup,
    token_counts, topk_search, url_filter,
)
from demandloom.llm.common import stage

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk_search.whole_vectors(_table(spark, sf, "embeddings"), scale=64)
    return topk_search.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf, "documents"), size=3, similarity=0.9)


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf, "documents"), window=50).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op4_mixing_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Targets between the present shares and equal ones for source and language;
    topics keep their shares; half of the tokens are kept."""
    measured = stage(mixing.measure(_table(spark, sf, "documents")), "mixing-measured")
    return mixing.mix_all(measured)


def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    measured = stage(quality.measure(_table(spark, sf, "documents")), "quality-measures")
    scorer = quality.train(measured, _table(spark, sf, "labels"), ~held_out)
    return quality.score(measured, scorer).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: (verdict, rule) pairs of the URL query.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf, "pages"), URL_RULES)


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf, "pages"))


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    learning = language_id.learning_fold()
    model = language_id.learn(docs.where(learning))
    return language_id.identify(docs, model).select(
        "doc_id", F.coalesce(~learning, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages", "shares")


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(
        _table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf, "documents"), support=100, longest=5, most=2000)


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(_table(spark, sf, "documents"), tampered)


def op13_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), size=5, similarity=0.85)


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_exact_topk": op1_exact_topk,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_mixing_weights": op4_mixing_weights,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_url_filter": op6_url_filter,
        "op7_html_extraction": op7_html_extraction,
        "op8_language_id": op8_language_id,
        "op9_token_counts": op9_token_counts,
        "op10_decontamination": op10_decontamination,
        "op11_collocations": op11_collocations,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_minhash_dedup": op13_minhash_dedup,
        "pipeline": corpus_pipeline.run,
    }


#: Words of a text in SQL.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH words AS (
  SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
firsts AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
  FROM windows JOIN firsts USING (key) WHERE doc_id > least),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM words)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum([a[1] * a[2] FOR a IN list_zip(q.e, v.e)])::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

def groups_sql(size: int, percent: int, more: str = "") -> str:
    """Components of texts linked by sets of ``size``-word shingles at ``percent`` of similarity."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce({_WORDS.format(lowered)}, []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {size - 1}], ' ') FOR i IN range(1, len(w) - {size - 2})]) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
rare AS (SELECT x FROM items GROUP BY x HAVING count(*) > 1),
shared AS (SELECT doc_id, x FROM items SEMI JOIN rare USING (x)),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i
  FROM shared p JOIN shared q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= {percent} * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS r FROM links UNION SELECT b, b FROM links
  UNION SELECT b.b, reach.r FROM reach JOIN both_ways b ON b.a = reach.doc_id)
SELECT doc_id, n::BIGINT AS n_shingles, coalesce(least(doc_id, m), doc_id) AS component_id{more}
FROM sizes LEFT JOIN (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
runs AS (SELECT lang, w, unnest(range(1, 6)) AS size FROM pieces),
found AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS a FROM (
    SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM runs WHERE len(w) >= size)
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM found WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n, 1000 * c.a * n // (h.a * t.a) AS score
  FROM cuts c JOIN found h ON h.lang = c.lang AND h.phrase = head JOIN found t ON t.lang = c.lang AND t.phrase = tail
  JOIN totals z ON z.lang = c.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + part - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT *, unnest(range(1, size - part + 2)) AS i FROM (
      SELECT *, unnest(range(2, size)) AS part FROM found WHERE size > 2)) GROUP BY ALL),
ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest l LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def manifest_sql(levels: int = 6, top_levels: int = 4) -> str:
    """The manifest for groups of up to 16 ** levels rows and 16 ** top_levels groups."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32, a bit at a time; -1 stands for a shift.
    crc = ("xor(list_reduce([4294967295::BIGINT] || flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] "
           "FOR c IN string_split(doc_id::VARCHAR, '')]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
           "WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)")

    def tree(name: str, depth: int) -> str:
        """CTEs name_0 (grp, pos, n, node) to name_depth, each with the siblings of its nodes."""
        out = ""
        for k in range(depth):
            run = f"PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN"
            out += f""",
{name}_s{k} AS (SELECT *, n > 1 AS step,
  coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
  coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights FROM {name}_{k}),
{name}_{k + 1} AS (
  SELECT grp, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node
  FROM {name}_{k} GROUP BY grp, pos // 16)"""
        return out

    def climb(name: str, depth: int, start: str) -> str:
        """Columns of the path of a node: one step of folding per level."""
        out = start
        for k in range(depth):
            out = f"""(SELECT p.*, CASE WHEN s.step THEN p.proof || s.lefts || s.rights ELSE p.proof END AS proof_,
  CASE WHEN s.step THEN sha256(s.lefts || p.fold || s.rights) ELSE p.fold END AS fold_
  FROM {out} p JOIN {name}_s{k} s ON s.grp = p.{name}_grp AND s.pos = p.{name}_pos // {16 ** k})"""
            out = f"(SELECT * EXCLUDE (proof, fold, proof_, fold_), proof_ AS proof, fold_ AS fold FROM {out})"
        return out

    return f"""
WITH leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
         {leaf("text")} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} END AS tampered
  FROM documents),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM leaves),
low_0 AS (SELECT grp, pos, n, leaf AS node FROM numbered){tree("low", levels)},
top_0 AS (SELECT 0 AS grp, grp AS pos, count(*) OVER () AS n, node FROM low_{levels}){tree("top", top_levels)},
start AS (
  SELECT doc_id, leaf, grp AS low_grp, pos AS low_pos, 0 AS top_grp, grp AS top_pos, '' AS proof,
         coalesce(tampered, leaf) AS fold FROM numbered),
paths AS (SELECT * FROM {climb("top", top_levels, climb("low", levels, "start"))})
SELECT doc_id, leaf, l.node AS subroot, t.node AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = t.node AS verified
FROM paths JOIN low_{levels} l ON l.grp = low_grp JOIN top_{top_levels} t ON true
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_topk": OP1_SQL, "op2_ngram_jaccard": groups_sql(3, 90), "op3_substring_dedup": OP3_SQL,
        "op11_collocations": OP11_SQL, "op12_merkle_manifest": manifest_sql(),
        "op13_minhash_dedup": groups_sql(5, 85, ", coalesce(least(doc_id, m), doc_id) = doc_id AS kept"),
    }

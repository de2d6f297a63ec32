"""The queries of the training-data operators: name to a function of (spark, sf_dir), and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provena.llm import chat, decontaminate, divergence, language_model, near_dup, packing, pii, quality_model, quality_rules, sharding, suffix_dedup, url_filter, vector_codes
from provena.llm.common import documents


def word_tokenizer() -> str:
    """Path of the packing tokenizer's vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: Patterns over parts that the urls of pages have.
PAGE_PATTERNS = ("||blog.", "||m.*.example.net^", "?page=2&", "/es/*7", "#top^", "@@||blog.*/fr/")


def url_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter of op1 with patterns that pages' urls meet, and without host rules: wildcards, anchors, separators and an exception decide."""
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), host_rules=(), patterns=PAGE_PATTERNS)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(documents(spark, sf_dir), redact=False)
    return found.select("doc_id", *[f"n_{k}" for k in pii.BASE_KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    return packing.pack(packing.tokenize(documents(spark, sf_dir), tokenizer_path or word_tokenizer(), with_ids=False))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document: doc_id, the items, the tokens of the best one."""
    found = decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("item_ids") > 0)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filters, url_patterns, op2_pii, op3_lm_scoring, op4_quality_classifier, op5_quality_rules, op6_best_fit_packing, op7_near_dedup, op8_sharding, op9_decontamination, op10_chat_formatting, op11_vector_codes, op12_divergence_audit, op13_suffix_dedup)}


OP1_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(coalesce(regexp_extract(url, '^(?:.|\n)*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?:.|\n)*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM u),
p AS (
  SELECT *, lower(url) AS low FROM r),
m AS (
  SELECT *, (SELECT max_by(p.v, length(p.v)) FROM (VALUES ('/cgi-bin/'), ('/wp-admin/'), ('/wp-login.php'), ('/login/'), ('/signin/'), ('/checkout/'), ('?sessionid='), ('&sessionid='), ('?phpsessid='), ('&phpsessid='), ('/search?q='), ('/casino/'), ('/xxx/')) p(v) WHERE contains(low, p.v)) AS found
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN contains(low, '/press/release/') THEN 'allow'
       WHEN found IS NOT NULL OR regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?(doubleclick\.net([^a-z0-9_.%-]|$)|adserver\.)') THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN NULL WHEN contains(low, '/press/release/') THEN '@@/press/release/' ELSE found END AS pattern
FROM m
"""

PATTERNS_SQL = r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?:.|\n)*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '^(?:.|\n)*?://[^/?#]*([^?#]*)', 1), '') AS path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
m AS (
  SELECT *, regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?blog\..*/fr/') AS spared, CASE
    WHEN regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?m\..*\.example\.net([^A-Za-z0-9_.%-]|$)') THEN '||m.*.example.net^'
    WHEN contains(low, '?page=2&') THEN '?page=2&'
    WHEN regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?blog\.') THEN '||blog.'
    WHEN regexp_matches(low, '/es/.*7') THEN '/es/*7'
    WHEN regexp_matches(low, '#top([^A-Za-z0-9_.%-]|$)') THEN '#top^' END AS found
  FROM u)
SELECT page_id, host, path, NULL::VARCHAR AS rule, CASE WHEN spared OR found IS NULL THEN 'allow' ELSE 'block' END AS verdict, CASE WHEN spared THEN '@@||blog.*/fr/' ELSE found END AS pattern
FROM m
"""

OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, 'unknown'), coalesce(text, ''))::INTEGER AS position
  FROM conversations),
c AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
b AS (
  SELECT t.*, c.perspective, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
  FROM t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id),
h AS (
  SELECT *, '<|' || chat_role || '|>' ||
    CASE WHEN chat_role = 'user' THEN regexp_replace(translate(speaker, chr(13) || chr(10), '  '), '<(\\*)\|', '<\\\1|', 'g') ELSE '' END || chr(10) AS head
  FROM b)
SELECT conv_id, perspective, turn, position, speaker, chat_role, CASE WHEN chat_role = 'user' THEN speaker END AS name,
  head || body || '<|end|>' || chr(10) AS message, speaker = perspective AS mask,
  CASE WHEN speaker = perspective THEN length(head)::BIGINT END AS mask_start,
  CASE WHEN speaker = perspective THEN (length(head) + length(body) + 7)::BIGINT END AS mask_end
FROM h
"""


def op11_sql(rounds: int = 4) -> str:
    """Lloyd's rounds by exhaustive search, one after the other."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT x.part, x.vec_id, x.v, min(struct_pack(d := list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := b.entry)) AS best
  FROM x JOIN b{k} b USING (part) GROUP BY x.part, x.vec_id, x.v)""")
        if k < rounds:
            steps.append(f"""
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
  FROM b{k} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v
    FROM (SELECT part, best.e AS entry, pos, sum(v[pos])::BIGINT AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 1 + (SELECT max(length(v)) FROM x))) AS pos) GROUP BY ALL)
    GROUP BY part, entry) m USING (part, entry))""")
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE length(embedding) > 0 AND length(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = length(embedding)),
x AS MATERIALIZED (SELECT part, vec_id, v[part * (length(v) // 4) + 1 : (part + 1) * (length(v) // 4)] AS v FROM k, (SELECT unnest(range(0, 4)) AS part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM x WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256)),
{",".join(steps)},
c AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM c JOIN k USING (vec_id), h
"""


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS term_n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
l AS (SELECT lang, count(*) AS v, sum(term_n) AS lang_n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (
  SELECT d.lang, d.source, coalesce(any_value(l.v), 0) AS v, any_value(l.lang_n) AS lang_n, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS group_n
  FROM d LEFT JOIN l USING (lang) GROUP BY d.lang, d.source),
e AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.group_n + g.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.term_n + 1)) // (g.lang_n + g.v)::HUGEINT AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM e x JOIN e y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item))::INTEGER AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, encode(term))::INTEGER FROM e WHERE n > 0 AND p > q)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT row, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT row, doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM w WHERE length(s) = 100 GROUP BY s),
x AS (SELECT w.row, w.i, substr(w.s, 1, 2) AS byte, coalesce(m.least < w.doc_id, false) AS starts FROM w LEFT JOIN m ON w.s = m.s),
y AS (SELECT row, i, byte, max(starts) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM x),
z AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY row ORDER BY i), false) AS opens FROM y),
g AS (SELECT row, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS rest FROM z GROUP BY row)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(g.n_removed, 0)::BIGINT AS n_removed, coalesce(g.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(g.rest, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (row)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "url_patterns": PATTERNS_SQL, "op10_chat_formatting": OP10_SQL, "op11_vector_codes": op11_sql(), "op12_divergence_audit": OP12_SQL, "op13_suffix_dedup": OP13_SQL}

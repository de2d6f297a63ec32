"""DuckDB SQL for the queries. Word lists are spliced in from the lexicons; the logic is written out in SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from provena import lexicons as lx


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(key: str, *values: str) -> str:
    return f"list_extract([{', '.join(map(q, values))}], ({key} % {len(values)})::INT + 1)"


def has(column: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {q(w)})" for w in words) + ")"


def first(column: str, words: Sequence[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, {q(w)}) THEN {q(w)}" for w in words) + " END"


def first_tag(column: str, lexicon: Mapping[str, Sequence[str]], other: str = "''") -> str:
    return "CASE " + " ".join(f"WHEN {has(column, words)} THEN {q(tag)}" for tag, words in lexicon.items()) + f" ELSE {other} END"


def tags(column: str, *lexicons: Mapping[str, Sequence[str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {has(column, words)} THEN {q(tag)} END" for lexicon in lexicons for tag, words in lexicon.items()) + "], lambda x: x IS NOT NULL)"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["''']([^"''']*)["'''][^>]*>(.*?)</a>""".replace("'''", "''")
LINKS = f"""links AS (
  SELECT page_id, url, place - 1 AS place, href, {squeeze("regexp_replace(inner_html, '<[^>]*>', ' ', 'g')")} AS anchor_text
  FROM (SELECT page_id, url, unnest(range(1, len(h) + 1)) AS place, unnest(h) AS href, unnest(i) AS inner_html
        FROM (SELECT page_id, url, regexp_extract_all(html, '{ANCHOR}', 1) AS h, regexp_extract_all(html, '{ANCHOR}', 2) AS i FROM pages))
  WHERE href <> '')"""
LABELS = " UNION ALL ".join(
    f"""SELECT l.*, {q(kind)} AS source_type, {first('words', hints)} AS hint FROM worded l""" for kind, hints in lx.LINK_HINTS.items()
)
KIND4 = pick("doc_id", "housing", "ranking", "career", "program_catalog")


def signal(kind: str, low: str) -> str:
    cases = " ".join(f"WHEN {kind} = {q(k)} THEN least(1.0, ({' + '.join(f'contains({low}, {q(w)})::INT' for w in words)}) / {float(max(2, len(words)))}::DOUBLE)" for k, words in lx.SIGNALS.items() if k in ("housing", "career", "program_catalog"))
    return f"CASE {cases} ELSE 0.5 END"


def typed(ids: int, *types: str) -> str:
    return f"k AS (SELECT 'k' || n_nationkey % {ids} AS sid, arg_max({pick('n_nationkey', *types)}, n_nationkey) AS kind FROM nation GROUP BY 1)"


JUDGED = f"""s AS (SELECT *, {signal('kind', 'low')} AS sig, {first_tag('low', lx.BLOCKS, 'NULL')} AS block FROM d),
r AS (SELECT *, CASE WHEN failed THEN 'fetch_failed' WHEN block IS NOT NULL THEN block WHEN n < 800 THEN 'too_short' WHEN sig <= 0 THEN 'low_signal' ELSE 'usable' END AS status FROM s)
SELECT doc_id, n AS text_len, status,
  CASE WHEN failed THEN 'fetch failed' WHEN block IS NOT NULL THEN 'matched ' || block || ' pattern' WHEN n < 120 THEN 'text_len < 120' WHEN n < 800 THEN 'text_len < 800'
       WHEN status = 'low_signal' THEN 'missing expected keywords for ' || kind ELSE 'passed basic content checks' END AS reason,
  format('{{:.2f}}', CASE WHEN failed OR block IS NOT NULL OR n < 120 THEN 0.0 WHEN n < 800 THEN 0.15 WHEN status = 'low_signal' THEN 0.2 ELSE sig END::DOUBLE) AS score
FROM r"""
CLASSIFY = f"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, {KIND4} AS kind, lower(coalesce(source, '') || ' ' || coalesce(text, '')) AS low, doc_id % 50 = 7 AS failed FROM documents), {JUDGED}"""
RECLASSIFY = f"""WITH {typed(4, 'housing', 'career', 'program_catalog')},
d AS (SELECT doc_id, length(coalesce(text, '')) AS n, coalesce(kind, '') AS kind, lower(coalesce(source, '') || ' ' || coalesce(text, '')) AS low, doc_id % 50 = 7 AND doc_id % 3 <> 0 AS failed FROM documents LEFT JOIN k ON sid = 'k' || doc_id % 5), {JUDGED}"""

MONEY_BODY = f"""'The annual ' || {pick('o_orderkey', 'tuition', 'deposit', 'housing', 'living cost')} || ' for this order is ' || {pick('o_custkey', 'USD', '£', 'EUR', 'S$', '¥')} || ' ' || floor(o_totalprice)::BIGINT || ' to ' || floor(o_totalprice * 1.1)::BIGINT || '.'"""
MONEY = rf"""
WITH t AS (SELECT o_orderkey, {MONEY_BODY} AS body FROM orders),
m AS (SELECT *, regexp_extract(body, '(?:USD|£|EUR|S\$|¥) \d{{4,6}}(?: to \d{{4,6}})?') AS raw, regexp_extract(body, '(USD|£|EUR|S\$|¥) \d{{4,6}}', 1) AS sign, regexp_extract(body, '(?:USD|£|EUR|S\$|¥) (\d{{4,6}})', 1) AS one, regexp_extract(body, '(?:USD|£|EUR|S\$|¥) \d{{4,6}} to (\d{{4,6}})', 1) AS two FROM t),
l AS (SELECT *, lower(body) AS low, {has('lower(body)', lx.MONEY_REJECT)} AS odd FROM m WHERE raw <> ''),
k AS (SELECT *, CASE WHEN odd THEN {first_tag('low', {k: v for k, v in lx.MONEY_LABELS.items() if k != 'tuition_fee'}, q('reject'))} ELSE {first_tag('low', lx.MONEY_LABELS, q('reject'))} END AS label FROM l)
SELECT o_orderkey, CASE WHEN label = 'tuition_fee' THEN 'tuition' ELSE label END AS fact_type, label AS fact_key, raw AS value_text,
  least(one::BIGINT, nullif(two, '')::BIGINT)::VARCHAR AS value_number, CASE sign WHEN '£' THEN 'GBP' WHEN 'S$' THEN 'SGD' WHEN '¥' THEN 'JPY' ELSE sign END AS value_currency,
  CASE WHEN label = 'tuition_fee' THEN '0.74' ELSE '0.55' END AS confidence_score, greatest(one::BIGINT, nullif(two, '')::BIGINT)::VARCHAR AS json_max, rtrim(body, '.') AS context
FROM k WHERE label <> 'reject'"""

USD_RANGE = f"""
WITH t AS (SELECT n_name AS university_id, floor(o_totalprice)::DOUBLE AS lo, floor(o_totalprice * 1.5)::DOUBLE AS hi, CASE {pick('o_orderkey', 'USD', 'GBP', 'JPY', 'zzz', 'SGD')} WHEN 'USD' THEN 1.0 WHEN 'GBP' THEN 1.25 WHEN 'JPY' THEN 0.0065 WHEN 'SGD' THEN 0.74 END::DOUBLE AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT university_id, min(round_even(lo * rate, 0)::BIGINT) AS usd_min, max(round_even(hi * rate, 0)::BIGINT) AS usd_max FROM t GROUP BY 1"""

ENGLISH = f"""
WITH t AS (SELECT p_partkey, p_partkey % 3 AS r, {pick('p_partkey', 'IELTS', 'TOEFL', 'PTE')} AS test, p_size FROM part),
s AS (SELECT *, CASE WHEN r = 0 THEN CASE WHEN 1 + p_size % 9 >= 5 THEN (1 + p_size % 9) || '.5' END ELSE (10 + p_size * 2)::VARCHAR END AS written FROM t),
v AS (SELECT *, written::DOUBLE AS score, CASE WHEN r = 0 THEN CASE WHEN written::DOUBLE BETWEEN 4 AND 9 THEN 'overall' END WHEN r = 1 THEN CASE WHEN written::DOUBLE BETWEEN 40 AND 120 THEN 'overall' WHEN written::DOUBLE BETWEEN 0 AND 30 THEN 'subscore' END
  WHEN written::DOUBLE BETWEEN 30 AND 90 THEN 'overall' END AS verdict FROM s),
f AS (SELECT p_partkey, CASE verdict WHEN 'overall' THEN test ELSE test || '_subscore' END AS fact_key, test || ' ' || written AS value_text, format('{{:.1f}}', score) AS value_number, CASE verdict WHEN 'overall' THEN '0.72' ELSE '0.48' END AS confidence_score FROM v WHERE verdict IS NOT NULL),
b AS (SELECT p_partkey, {pick('p_partkey', 'IELTS', 'TOEFL iBT', 'PTE')} || ' overall score of ' || CASE WHEN p_partkey % 3 = 0 THEN (1 + p_size % 9) || '.5' ELSE (10 + p_size * 2)::VARCHAR END || ' is needed' AS body FROM part)
SELECT * FROM f UNION ALL SELECT p_partkey, 'summary', body, '', '0.58' FROM b WHERE length(body) >= 30"""

CERTS = f"""
WITH t AS (SELECT p_partkey, {pick('p_partkey', 'SAT', 'act', 'ACT', 'GRE', 'A-levels', 'HSK')} AS word, {pick('p_size', 'required', 'optional', 'certificate needed', 'see below')} AS more FROM part)
SELECT p_partkey, CASE word WHEN 'A-levels' THEN 'A_LEVEL' ELSE word END AS fact_key, '0.72' AS confidence_score FROM t WHERE more <> 'certificate needed' AND word <> 'act'"""

DEADLINES = f"""
WITH t AS (SELECT o_orderkey, {pick('o_orderkey', 'early', 'regular', 'final')} AS kind, {pick('o_custkey', 'deadline', 'date')} AS word, strftime(o_orderdate, '%-d %b %Y') AS d FROM orders)
SELECT o_orderkey, d AS date_text, CASE kind WHEN 'final' THEN '' ELSE kind END AS round_name, 'bachelor' AS degree_level, 'The ' || kind || ' application deadline is ' || d || ' for bachelor study' AS sentence, CASE kind WHEN 'final' THEN '0.62' ELSE '0.72' END AS confidence
FROM t WHERE word = 'deadline'"""

PROGRAMS = rf"""
WITH {typed(5, 'program_catalog', 'tuition_fees', 'program_catalog')}, t AS (SELECT p_partkey, 'We offer Bachelor of ' || p_name || '; and ' || {pick('p_partkey', 'Master of Laws', 'PhD in physics', 'nothing')} || '. End' AS body FROM part JOIN k ON sid = 'k' || p_partkey % 5 WHERE kind = 'program_catalog' AND p_size % 7 <> 0 AND p_size % 6 <> 0),
u AS (SELECT p_partkey, unnest(list_slice(regexp_extract_all(body, '(?i)((?:Bachelor|Master|MSc|MA|BSc|PhD|MBA)[^.;:\n]{{3,80}})', 1), 1, 20)) AS raw FROM t),
n AS (SELECT p_partkey::VARCHAR AS university_id, trim({squeeze('raw')}, ' .;:-') AS name FROM u)
SELECT 'program_' || substr(sha1(university_id || '|' || lower(trim(name))), 1, 16) AS program_id, university_id, name, lower(name) AS normalized_name, {first_tag('lower(name)', lx.STUDY_LEVELS)} AS degree_level, {first_tag('lower(name)', lx.SUBJECTS)} AS field_of_study FROM n"""

TAG_SETS = f"""
WITH t AS (SELECT source, unnest({tags('lower(text)', lx.SUBJECTS)} || {tags('lower(text)', lx.STUDY_LEVELS)} || {tags('lower(text)', lx.VIBES)} || {tags('lower(text)', lx.SUPPORTS)}) AS tag FROM documents)
SELECT source, array_to_string(list_slice(list_sort(list_distinct(list(tag))), 1, 5), ',') AS tags, count(*) AS n FROM t GROUP BY source"""

EVENT_FACTS = f"""ef AS (SELECT event_id AS ord, 'f' || event_id % 7000 AS fact_id, 'u' || user_id % 40 AS university_id, {pick('event_id', 'application', 'english_requirement', 'cert_requirement')} AS fact_type,
  CASE event_id % 3 WHEN 0 THEN {pick('user_id', 'application_system', 'portfolio_required')} WHEN 1 THEN {pick('user_id', 'IELTS', 'TOEFL', 'PTE_subscore')} ELSE {pick('user_id', 'SAT', 'A_LEVEL', 'IB', 'GRE', 'TOPIK')} END AS fact_key,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE 'IELTS ' || (4 + event_id % 6) || '.5' END AS value_text,
  {pick('event_id', 'llm_extracted_from_source', 'generated_by_rule', 'manual', 'extracted_from_source', 'extracted_from_source', 'inferred_from_text', 'extracted_from_source')} AS fact_origin FROM events)"""
FACTS_UNION = f"""
WITH {EVENT_FACTS}, m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY ord % 2, ord) AS k FROM ef) WHERE k = 1)
SELECT fact_id, university_id, fact_origin, 'extracted' AS part FROM m WHERE fact_origin IN ('extracted_from_source', 'llm_extracted_from_source', 'manual')
UNION ALL SELECT fact_id, university_id, fact_origin, 'generated' FROM m WHERE fact_origin NOT IN ('extracted_from_source', 'llm_extracted_from_source', 'manual')
UNION ALL SELECT fact_id, university_id, fact_origin, 'model' FROM m WHERE fact_origin = 'llm_extracted_from_source'"""
PREFER = f"""
WITH {EVENT_FACTS}, k AS (SELECT *, fact_origin = 'llm_extracted_from_source' AS model FROM ef)
SELECT university_id, fact_type, fact_key, CASE WHEN bool_or(model) THEN arg_min(value_text, ord) FILTER (model AND value_text <> '') ELSE arg_min(value_text, ord) FILTER (NOT model AND value_text <> '') END AS value FROM k GROUP BY 1, 2, 3"""
FIRST_VALUE = f"""
WITH {EVENT_FACTS} SELECT university_id, fact_type, fact_key, fact_origin = 'llm_extracted_from_source' AS model, count(*) AS n, arg_min(value_text, ord) FILTER (value_text <> '') AS first FROM ef GROUP BY 1, 2, 3, 4"""
SUMMARY = f"""
WITH {EVENT_FACTS}, v AS (SELECT university_id, fact_origin = 'llm_extracted_from_source' AS model, value_text, min(ord) AS pos FROM ef WHERE fact_type = 'english_requirement' AND value_text <> '' GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY university_id, model ORDER BY pos) AS k FROM v)
SELECT university_id, model, string_agg(value_text, ' or ' ORDER BY pos) AS summary FROM r WHERE k <= 3 GROUP BY 1, 2"""
CERT_JOIN = f"""
WITH {EVENT_FACTS}, d AS (SELECT DISTINCT university_id, fact_key FROM ef WHERE fact_type = 'cert_requirement')
SELECT university_id, string_agg(CASE fact_key WHEN 'A_LEVEL' THEN 'A-Level' ELSE fact_key END, '; ' ORDER BY fact_key) AS summary FROM d GROUP BY 1"""

ADMISSIONS = ", ".join(map(q, lx.ADMISSIONS))
ROUTED = ("scholarships", "program_catalog", "undergraduate_admissions", "housing", "tuition_fees", "career", "graduate_admissions")
PAGE_TEXTS = ("Our residence and housing office", "Career and internship service", "We do not offer scholarships", "Apply with UCAS: portfolio and interview", "Rolling admission for bachelor of law", "Scholarship for master students", "Nothing more")


def each(found: str, fact_type: str, key: str, score: str, origin: str = "extracted_from_source", where: str = "true") -> str:
    return f"SELECT id, {q(fact_type)} AS fact_type, {q(key)} AS fact_key, unnest({found}) AS value_text, {q(score)} AS confidence_score, {q(origin)} AS fact_origin FROM t WHERE {where}"


def known(value: str) -> str:
    return f"list_filter([{value}], lambda x: x IS NOT NULL)"


GRANTS = first("low", lx.SUPPORTS["scholarship"])
ROUTING = f"""WITH {typed(6, *ROUTED)}, t AS (SELECT p_partkey::VARCHAR AS id, lower(p_name || '. ' || {pick('p_size', *PAGE_TEXTS)} || '.') AS low, coalesce(kind, '') AS st FROM part LEFT JOIN k ON sid = 'k' || p_partkey % 7
  WHERE p_partkey % 9 <> 4 AND (p_partkey // 7) % 3 <> 2)
""" + " UNION ALL ".join((
    each(tags("low", lx.VIBES), "matching", "campus_vibe_tag", "0.45", "generated_by_rule"), each(tags("low", lx.SUPPORTS), "matching", "support_tag", "0.60", "inferred_from_text"),
    each(tags("low", lx.SUBJECTS), "matching", "subject_tag", "0.62", "inferred_from_text", f"st IN ('program_catalog', {ADMISSIONS})"), each(tags("low", lx.STUDY_LEVELS), "matching", "study_level_tag", "0.62", "inferred_from_text", f"st IN ('program_catalog', {ADMISSIONS})"),
    each(known(first("low", ("housing", "accommodation", "residence"))), "support", "housing_support", "0.62", where="st = 'housing'"), each(known(first("low", ("career", "employability", "internship"))), "support", "career_services", "0.62", where="st = 'career'"),
    each(known(GRANTS), "support", "scholarship", "0.62", where="st = 'scholarships'"), each("['true']", "scholarship", "scholarship_available", "0.68", where=f"st = 'scholarships' AND {GRANTS} IS NOT NULL"),
    each("['false']", "scholarship", "scholarship_available", "0.55", where=f"st = 'scholarships' AND {GRANTS} IS NULL AND {has('low', ('no scholarship', 'not offer scholarships'))}"),
    each(tags("low", lx.SUBJECTS), "program", "field_of_study", "0.58", where="st = 'program_catalog'"), each(tags("low", lx.STUDY_LEVELS), "program", "degree_level", "0.58", where="st = 'program_catalog'"),
    each(known(first_tag("low", lx.APPLICATION_SYSTEMS, "NULL")), "application", "application_system", "0.70", where=f"st IN ({ADMISSIONS})"),
    *[each("['true']", "application", key, score, where=f"st IN ({ADMISSIONS}) AND contains(low, {q(word)})") for key, score, word in (("rolling_admission", "0.75", "rolling admission"), ("portfolio_required", "0.62", "portfolio"), ("interview_required", "0.58", "interview"))],
))
ROUTING = f"SELECT id AS evidence_id, fact_type, fact_key, value_text, confidence_score, fact_origin FROM ({ROUTING})"
MATCHED = """WITH c AS (SELECT s_nationkey, s_suppkey, s_name, (62 + s_suppkey * 7 % 39) / 100.0::DOUBLE AS score FROM supplier),
r AS (SELECT *, row_number() OVER w AS place, lead(score) OVER w AS later FROM c WINDOW w AS (PARTITION BY s_nationkey ORDER BY score DESC, s_suppkey)),
m AS (SELECT *, n_nationkey % 3 = 0 AS had, coalesce(score >= 0.88::DOUBLE AND NOT coalesce(score - later < 0.04::DOUBLE, false), false) AS sure FROM nation LEFT JOIN (SELECT * FROM r WHERE place = 1) ON s_nationkey = n_nationkey),
t AS (SELECT *, CASE WHEN sure THEN CASE WHEN had THEN 'updated' ELSE 'matched' END WHEN had THEN 'existing_preserved' WHEN score IS NOT NULL THEN 'ambiguous' ELSE 'unmatched' END AS match_status FROM m)
SELECT n_name AS university_id, CASE WHEN sure THEN s_suppkey::VARCHAR WHEN had THEN (n_nationkey + 1)::VARCHAR ELSE '' END AS qs_rank, CASE WHEN (sure AND n_nationkey % 3 <> 1) OR had THEN '7' ELSE '' END AS the_rank,
  CASE WHEN sure THEN '#' || s_suppkey WHEN had THEN 'old' ELSE '' END AS rank_display, CASE WHEN sure THEN CASE WHEN s_suppkey % 2 = 1 THEN 'needs_review' ELSE 'approved' END WHEN had THEN 'approved' ELSE 'needs_review' END AS review_status,
  CASE WHEN sure THEN 'QS 2026 official match' WHEN had THEN 'kept' ELSE 'No ranking match yet' END AS notes, match_status, coalesce(s_name, '') AS matched_name, coalesce(format('{:.3f}', score), '') AS confidence_score,
  CASE match_status WHEN 'existing_preserved' THEN 'Existing approved rank preserved; new match not confident enough' WHEN 'ambiguous' THEN 'Needs manual ranking review' WHEN 'unmatched' THEN 'No QS match candidate' ELSE 'QS match auto-approved' END AS said FROM t"""

SOURCES = f"""os AS (SELECT o_orderkey AS ord, 'o' || o_orderkey AS source_id, 'c' || o_custkey AS university_id, {pick('o_orderkey', 'official_home', 'undergraduate_admissions', 'tuition_fees', 'english_requirements', 'housing', 'career')} AS source_type,
  'https://example.org/' || o_orderkey AS url, substr(o_orderpriority, 1, 1) AS priority, CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'P' THEN 'manual' ELSE 'failed' END AS status, o_orderstatus AS notes FROM orders)"""
COUNTED = f"""{SOURCES}, ev AS (SELECT l_orderkey, count(*) FILTER (l_returnflag <> 'A') AS usable, count(*) FILTER (l_returnflag = 'A') AS bad FROM lineitem GROUP BY 1), se AS (SELECT os.*, coalesce(usable, 0) AS usable, coalesce(bad, 0) AS bad FROM os LEFT JOIN ev ON l_orderkey = ord)"""
REQUIRED = ", ".join(map(q, lx.REQUIRED_SOURCE_TYPES))
COVERAGE = f"""WITH {COUNTED} SELECT university_id, format('{{:.2f}}', count(DISTINCT source_type) FILTER (status IN ('fetched', 'manual') AND usable > 0 AND source_type IN ({REQUIRED})) / 4.0::DOUBLE) AS coverage FROM se GROUP BY 1"""
BATCH = f"""WITH {COUNTED} SELECT university_id, count(*) AS source_count, count(*) FILTER (status = 'failed') AS failed_source_count, sum(usable)::BIGINT AS usable_evidence_count, sum(bad)::BIGINT AS blocked_evidence_count FROM se GROUP BY 1"""

SUBJECT7 = ("law", "business", "medicine", "education", "engineering", "hospitality", "humanities")
BUILT = f"""sf AS (SELECT 's' || l_suppkey AS uid, l_linenumber AS k, l_orderkey AS n, l_orderkey % 50 = 0 AS model, l_orderkey * 10 + l_linenumber AS ord, l_extendedprice AS price, strftime(l_shipdate, '%-d %b %Y') AS d FROM lineitem),
mn AS (SELECT uid, model, min(round_even(floor(price) * rate, 0)::BIGINT) AS lo, max(round_even(floor(price * 1.2) * rate, 0)::BIGINT) AS hi FROM (SELECT *, CASE n % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.25 WHEN 2 THEN 0.74 END::DOUBLE AS rate FROM sf WHERE k = 1) GROUP BY 1, 2),
money AS (SELECT uid, arg_max(struct_pack(lo := lo, hi := hi), model::INT) AS m FROM mn GROUP BY 1),
subj AS (SELECT uid, list_slice(list_sort(list_distinct(list({pick('n', *SUBJECT7)}))), 1, 5) AS subject_tags FROM sf WHERE k = 2 GROUP BY 1),
lev AS (SELECT uid, list_sort(list_distinct(list({pick('n', 'master', 'bachelor')}))) AS study_level_tags FROM sf WHERE k = 3 GROUP BY 1),
app AS (SELECT uid, CASE WHEN bool_or(model) THEN arg_min({pick('n', 'ucas', 'direct', 'ouac')}, ord) FILTER (model) ELSE arg_min({pick('n', 'ucas', 'direct', 'ouac')}, ord) END AS application_system FROM sf WHERE k = 4 GROUP BY 1),
schol AS (SELECT uid, (CASE WHEN bool_or(model) THEN arg_min({pick('n', 'true', 'false')}, ord) FILTER (model) ELSE arg_min({pick('n', 'true', 'false')}, ord) END) = 'true' AS scholarship_available FROM sf WHERE k = 6 GROUP BY 1),
ev1 AS (SELECT uid, model, 'IELTS ' || (4 + n % 5) || '.0' AS v, min(ord) AS pos FROM sf WHERE k = 5 GROUP BY 1, 2, 3),
ev2 AS (SELECT *, row_number() OVER (PARTITION BY uid, model ORDER BY pos, v) AS r, bool_or(model) OVER (PARTITION BY uid) AS any_model FROM ev1),
eng AS (SELECT uid, string_agg(v, ' or ' ORDER BY pos, v) AS english FROM ev2 WHERE r <= 3 AND model = any_model GROUP BY 1),
dl1 AS (SELECT uid, model, CASE n % 3 WHEN 0 THEN 'Early' WHEN 1 THEN 'Regular' ELSE 'Deadline' END || ': ' || d AS v, min(ord) AS pos FROM sf WHERE k = 7 GROUP BY 1, 2, 3),
dl2 AS (SELECT *, row_number() OVER (PARTITION BY uid, model ORDER BY pos, v) AS r, bool_or(model) OVER (PARTITION BY uid) AS any_model FROM dl1),
dead AS (SELECT uid, string_agg(v, '; ' ORDER BY pos, v) AS deadlines FROM dl2 WHERE r <= 3 AND model = any_model GROUP BY 1),
cnt AS (SELECT uid, count(*) AS fact_count, count(DISTINCT n) AS evidence_count, count(*) FILTER (k = 1) AS tuition_n, count(*) FILTER (k IN (4, 7)) AS app_n, count(*) FILTER (k = 7) AS dead_n, count(*) FILTER (k = 5) AS eng_n, count(*) FILTER (k IN (2, 3)) AS match_n FROM sf GROUP BY 1),
ps AS (SELECT 's' || (p_partkey % (SELECT count(*) FROM supplier) + 1) AS uid, {pick('p_size', 'official_home', 'undergraduate_admissions', 'tuition_fees', 'english_requirements', 'housing')} AS st, p_size % 3 = 0 AS failed, p_partkey % 4 <> 0 AS usable FROM part),
src AS (SELECT uid, count(*) AS source_count, count(*) FILTER (failed) AS failed_n, count(*) FILTER (usable) AS usable_n, count(*) FILTER (NOT usable) AS bad_n, count(DISTINCT st) FILTER (NOT failed AND usable AND st <> 'housing') / 4.0::DOUBLE AS cov FROM ps GROUP BY 1),
b0 AS (SELECT 's' || s_suppkey AS university_id, s_name AS display_name, n_name AS country, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'Town' END AS city, CASE WHEN s_suppkey % 3 = 0 THEN floor(s_acctbal)::BIGINT::VARCHAR ELSE '' END AS qs_rank,
  coalesce(subject_tags, []::VARCHAR[]) AS subject_tags, coalesce(study_level_tags, []::VARCHAR[]) AS study_level_tags, m.lo AS tlo, m.hi AS thi, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 9000 + n_nationkey * 100 END::BIGINT AS llo, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 15000 + n_nationkey * 100 END::BIGINT AS lhi,
  scholarship_available, coalesce(application_system, '') AS application_system, coalesce(deadlines, '') AS deadline_summary, coalesce(english, '') AS english_requirement_summary, coalesce(cov, 0.0) AS cov,
  coalesce(fact_count, 0) AS fact_count, coalesce(evidence_count, 0) AS evidence_count, coalesce(tuition_n, 0) AS tuition_n, coalesce(app_n, 0) AS app_n, coalesce(dead_n, 0) AS dead_n, coalesce(eng_n, 0) AS eng_n, coalesce(match_n, 0) AS match_n,
  coalesce(source_count, 0) AS source_count, coalesce(failed_n, 0) AS failed_n, coalesce(usable_n, 0) AS usable_n, coalesce(bad_n, 0) AS bad_n
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN money ON money.uid = 's' || s_suppkey LEFT JOIN subj ON subj.uid = 's' || s_suppkey LEFT JOIN lev ON lev.uid = 's' || s_suppkey LEFT JOIN app ON app.uid = 's' || s_suppkey
  LEFT JOIN schol ON schol.uid = 's' || s_suppkey LEFT JOIN eng ON eng.uid = 's' || s_suppkey LEFT JOIN dead ON dead.uid = 's' || s_suppkey LEFT JOIN cnt ON cnt.uid = 's' || s_suppkey LEFT JOIN src ON src.uid = 's' || s_suppkey),
b1 AS (SELECT *, CASE WHEN tlo < 500 OR thi > 120000 THEN NULL ELSE tlo END AS tuition_usd_min, CASE WHEN tlo < 500 OR thi > 120000 THEN NULL ELSE thi END AS tuition_usd_max FROM b0),
b2 AS (SELECT *, list_filter([CASE WHEN city = '' THEN 'city' END, CASE WHEN len(subject_tags) = 0 THEN 'subject_tags' END, CASE WHEN len(study_level_tags) = 0 THEN 'study_level_tags' END, CASE WHEN tuition_usd_min IS NULL THEN 'tuition_usd_min' END,
  CASE WHEN tuition_usd_max IS NULL THEN 'tuition_usd_max' END, CASE WHEN llo IS NULL THEN 'living_cost_usd_min' END, CASE WHEN lhi IS NULL THEN 'living_cost_usd_max' END, CASE WHEN scholarship_available IS NULL THEN 'scholarship_available' END,
  CASE WHEN application_system = '' THEN 'application_system' END, CASE WHEN deadline_summary = '' THEN 'deadline_summary' END, CASE WHEN english_requirement_summary = '' THEN 'english_requirement_summary' END], lambda x: x IS NOT NULL) AS missing FROM b1),
b3 AS (SELECT *, format('{{:.2f}}', round_even((16 - len(missing)) / 16.0::DOUBLE, 2)) AS data_quality_score, format('{{:.2f}}', cov) AS evidence_coverage_score,
  CASE WHEN len(missing) = 0 THEN 'ready_for_import' WHEN city = '' THEN 'do_not_import' WHEN len(subject_tags) > 0 AND len(study_level_tags) > 0 AND llo IS NOT NULL THEN 'internal_preview' ELSE 'identity_only' END AS import_status FROM b2)"""
FLAGSHIP = f"""WITH {BUILT}
SELECT university_id, display_name, country, qs_rank, array_to_string(subject_tags, ',') AS subject_tags, array_to_string(study_level_tags, ',') AS study_level_tags, array_to_string(list_sort(subject_tags), ',') AS strengths,
  array_to_string(list_sort(list_filter([CASE WHEN len(subject_tags) > 0 THEN 'students_interested_in_' || subject_tags[1] END, CASE WHEN list_contains(study_level_tags, 'master') THEN 'graduate_applicants' END], lambda x: x IS NOT NULL)), ',') AS best_for,
  tuition_usd_min, tuition_usd_max, llo AS living_cost_usd_min, lhi AS living_cost_usd_max, tuition_usd_min + llo AS total_cost_usd_min, tuition_usd_max + lhi AS total_cost_usd_max, scholarship_available, application_system, deadline_summary, english_requirement_summary,
  array_to_string(list_filter([deadline_summary, english_requirement_summary], lambda x: x <> ''), '; ') AS requirement_summary, evidence_coverage_score, data_quality_score, import_status,
  CASE WHEN import_status = 'ready_for_import' THEN 'needs_review' ELSE 'draft' END AS review_status, fact_count, evidence_count FROM b3"""
GAPS = f"WITH {BUILT} SELECT university_id, display_name, unnest(missing) AS missing_field, import_status FROM b3"
GATE = f"""WITH {BUILT}, g AS (SELECT avg((cov >= 1.0)::INT)::DOUBLE AS complete, avg(data_quality_score::DOUBLE) AS quality, avg((len(subject_tags) > 0 AND len(study_level_tags) > 0)::INT)::DOUBLE AS ready FROM b3),
u AS (SELECT 'universities_with_required_sources' AS metric, complete AS v, 0.90 AS t FROM g UNION ALL SELECT 'facts_with_evidence_links', 1.0, 1.00 UNION ALL SELECT 'average_data_quality_score', quality, 0.70 FROM g UNION ALL SELECT 'matching_readiness_rate', ready, 0.80 FROM g)
SELECT metric, format('{{:.2f}}', round_even(v, 2)::DOUBLE) AS value, format('{{:.2f}}', t::DOUBLE) AS threshold, CASE WHEN round_even(v, 2) >= t THEN 'pass' ELSE 'fail' END AS status FROM u"""
QA_STATUS = f"""WITH {BUILT}, s AS (SELECT *, import_status IN ('ready_for_import', 'internal_preview') AS good, tuition_n = 0 OR dead_n = 0 OR eng_n = 0 AS thin FROM b3)
SELECT university_id, display_name, source_count, usable_n AS usable_evidence_count, bad_n AS blocked_evidence_count, failed_n AS failed_source_count, tuition_n AS tuition_fact_count, tuition_n AS valid_tuition_fact_count, app_n AS deadline_fact_count, dead_n AS valid_deadline_fact_count,
  eng_n AS english_fact_count, eng_n AS valid_english_fact_count, match_n AS matching_tag_count, import_status, CASE WHEN good THEN 'ready_for_internal_preview' WHEN failed_n >= 4 THEN 'needs_source_repair' WHEN thin THEN 'needs_fact_repair' ELSE 'ready_for_internal_preview' END AS qa_status,
  CASE WHEN import_status = 'ready_for_import' THEN 'validated profile fields present' WHEN good THEN 'usable for internal product review' WHEN failed_n >= 4 THEN 'multiple failed sources' WHEN thin THEN 'missing validated tuition/deadline/English facts' ELSE 'minimum validated facts present' END AS qa_notes FROM s"""
FALLBACK = f"WITH {BUILT} SELECT university_id, country, llo AS living_cost_usd_min, lhi AS living_cost_usd_max FROM b3"

PAGES = f"""pg AS (SELECT page_id AS ord, page_id % 13 = 0 AS blank, CASE WHEN page_id % 13 = 0 THEN '' WHEN page_id % 3 = 0 THEN 'src_' || page_id ELSE '' END AS source_id, {pick('page_id', 'mit_us', 'cam_uk', 'ALGERIA', 'BRAZIL', 'zz')} AS raw_id,
  {pick('page_id', 'official_home', 'tuition_fees', 'blog')} AS source_type, CASE WHEN page_id % 7 = 0 THEN 'www' || url WHEN page_id % 5 = 0 THEN 'https://example.org/same' ELSE url END AS url, {pick('page_id', '', '1', 'x', '0')} AS priority, {pick('page_id', '', 'pdf', 'robot')} AS crawl_method FROM pages),
pj AS (SELECT *, CASE raw_id WHEN 'mit_us' THEN 'mit' WHEN 'cam_uk' THEN 'cambridge' ELSE raw_id END AS uid, regexp_matches(url, '^https?://[^/?#]+') AS good FROM pg),
pk AS (SELECT *, CASE WHEN blank THEN 'blank_row' WHEN NOT good THEN 'invalid_url' WHEN row_number() OVER (PARTITION BY blank OR NOT good, uid, source_type, url ORDER BY ord) > 1 THEN 'exact_duplicate' ELSE '' END AS reason FROM pj)"""
NORMALIZE = f"""WITH {PAGES}
SELECT CASE WHEN source_id <> '' THEN source_id ELSE 'src_' || substr(sha1(lower(uid) || '|' || source_type || '|' || lower(url)), 1, 16) END AS source_id, uid AS university_id,
  coalesce(upper(n_name[1]) || lower(n_name[2:]), 'named') AS university_name, coalesce(r_name, '') AS country, source_type, url, CASE priority WHEN '' THEN '2' ELSE priority END AS priority, 'en' AS language_code, CASE crawl_method WHEN '' THEN 'static' ELSE crawl_method END AS crawl_method,
  'pending' AS status, '' AS last_crawled_at, '' AS notes FROM pk LEFT JOIN nation ON n_name = uid LEFT JOIN region ON n_regionkey = r_regionkey WHERE reason = ''"""
DROPS = f"""WITH {PAGES} SELECT count(*) AS input_rows, count(*) FILTER (reason = '') AS output_rows, count(*) FILTER (NOT blank AND uid <> raw_id) AS mapped_university_ids, count(*) FILTER (reason = 'blank_row') AS removed_blank_rows, count(*) FILTER (reason = 'invalid_url') AS removed_invalid_url_rows,
  count(*) FILTER (reason = 'exact_duplicate') AS removed_exact_duplicates FROM pk"""
VALIDATE = f"""WITH {PAGES}, v AS (SELECT ord + 2 AS row_number, CASE WHEN blank THEN '' ELSE raw_id END AS uid, CASE WHEN blank THEN '' ELSE source_type END AS st, CASE WHEN blank THEN '' ELSE url END AS url, CASE WHEN blank THEN '' ELSE priority END AS pr, CASE WHEN blank THEN '' ELSE crawl_method END AS cm, good AND NOT blank AS good FROM pj),
vb AS (SELECT row_number, CASE WHEN uid = '' THEN ' ' ELSE uid END AS uid, CASE WHEN uid = '' THEN ' ' ELSE st END AS st, CASE WHEN uid = '' THEN ' ' ELSE url END AS url, CASE WHEN uid = '' THEN ' ' ELSE pr END AS pr, CASE WHEN uid = '' THEN ' ' WHEN cm = '' THEN 'static' ELSE cm END AS cm, good FROM v),
w AS (SELECT *, row_number() OVER (PARTITION BY uid, st, url ORDER BY row_number) > 1 AS again FROM vb),
e AS (SELECT row_number, 'university_id ' || uid || ' not present in seed' AS m FROM w WHERE uid NOT IN (SELECT n_name FROM nation)
  UNION ALL SELECT row_number, 'unsupported source_type ' || st FROM w WHERE st NOT IN ({', '.join(map(q, lx.SOURCE_TYPES))})
  UNION ALL SELECT row_number, 'unsupported crawl_method ' || cm FROM w WHERE cm NOT IN ({', '.join(map(q, lx.CRAWL_METHODS))})
  UNION ALL SELECT row_number, 'invalid url ' || url FROM w WHERE NOT good
  UNION ALL SELECT row_number, 'duplicate source for ' || uid || ' ' || st || ' ' || url FROM w WHERE again
  UNION ALL SELECT row_number, 'priority must be an integer' FROM w WHERE pr IN ('x', ' ')
  UNION ALL SELECT row_number, 'priority must be >= 1' FROM w WHERE pr = '0')
SELECT row_number, 'source row ' || row_number || ': ' || m AS message FROM e"""
RETRY = f"""WITH {SOURCES} SELECT source_id, university_id, '' AS university_name, '' AS country, source_type, url, priority, 'en' AS language_code, 'static' AS crawl_method, 'pending' AS status, '' AS last_crawled_at, notes FROM os WHERE status IN ('failed', 'skipped') AND source_type IN ('tuition_fees', 'housing')"""
REPAIRS = f"""WITH {SOURCES}, rp AS (SELECT 'c' || c_custkey AS uid, {pick('c_custkey', 'all_sources', 'tuition_fees', 'housing', 'career')} AS st, CASE WHEN c_custkey % 10 = 1 THEN '' ELSE 'https://fixed.example/' || c_custkey END AS url, CASE c_custkey % 2 WHEN 0 THEN 'pdf' ELSE 'static' END AS cm, c_mktsegment AS notes FROM customer),
kx AS (SELECT * FROM rp WHERE st <> 'all_sources' AND url <> ''), w AS (SELECT * FROM rp WHERE st = 'all_sources'),
b AS (SELECT os.*, row_number() OVER (PARTITION BY university_id, source_type ORDER BY ord) AS k FROM os),
j AS (SELECT b.*, kx.url AS kurl, kx.cm AS kcm, kx.notes AS knotes, w.uid AS wuid, w.cm AS wcm, w.notes AS wnotes, s_name FROM b LEFT JOIN kx ON kx.uid = university_id AND kx.st = source_type AND k = 1 LEFT JOIN w ON w.uid = university_id LEFT JOIN supplier ON 'c' || s_suppkey = university_id)
SELECT university_id, CASE WHEN kurl IS NOT NULL THEN coalesce(s_name, '') ELSE '' END AS university_name, source_type, coalesce(kurl, url) AS url, priority, CASE WHEN kurl IS NOT NULL THEN 'en' ELSE '' END AS language_code, CASE WHEN kurl IS NOT NULL THEN kcm WHEN wuid IS NOT NULL THEN wcm ELSE '' END AS crawl_method,
  'pending' AS status, CASE WHEN kurl IS NOT NULL THEN knotes WHEN wuid IS NOT NULL THEN wnotes ELSE notes END AS notes, CASE WHEN kurl IS NOT NULL OR wuid IS NOT NULL THEN 'updated' ELSE '' END AS change FROM j
UNION ALL SELECT kx.uid, coalesce(s_name, ''), kx.st, kx.url, '2', 'en', kx.cm, 'pending', kx.notes, 'added' FROM kx LEFT JOIN supplier ON 'c' || s_suppkey = kx.uid WHERE NOT EXISTS (SELECT 1 FROM os WHERE university_id = kx.uid AND source_type = kx.st)"""
MERGE = f"""WITH {SOURCES}, r AS (SELECT source_id, {pick('(ord // 3)', 'fetched', 'failed', 'skipped', 'manual')} AS status FROM os WHERE ord % 3 = 0),
j AS (SELECT os.source_id, os.status, os.notes, r.status AS again, coalesce(r.status = 'fetched' OR (os.status <> 'fetched' AND r.status IN ('failed', 'skipped')), false) AS replaced FROM os LEFT JOIN r USING (source_id))
SELECT source_id, CASE WHEN replaced THEN again ELSE status END AS status, CASE WHEN replaced THEN 'again' ELSE notes END AS notes, replaced FROM j"""
SEARCH = f"""WITH {SOURCES} SELECT 'c' || c_custkey AS university_id, t AS source_type, CASE t WHEN 'tuition_fees' THEN c_name || ' international tuition fees official' WHEN 'english_requirements' THEN c_name || ' English language requirements admissions official' ELSE c_name || ' career official' END AS search_query
FROM customer, (VALUES ('tuition_fees'), ('career'), ('english_requirements')) v(t) WHERE NOT EXISTS (SELECT 1 FROM os WHERE university_id = 'c' || c_custkey AND source_type = t)"""
PROMOTE = f"""WITH b AS (SELECT 'b' || s_suppkey AS source_id, 'n' || s_nationkey AS uid, 'https://example.org/' || s_suppkey % 50 AS url FROM supplier),
c AS (SELECT 'n' || p_partkey % 25 AS uid, {pick('p_partkey', 'tuition_fees', 'housing')} AS st, 'https://example.org/' || p_partkey % 60 AS url, p_size, row_number() OVER (PARTITION BY p_partkey % 25, p_partkey % 2, p_partkey % 60 ORDER BY p_partkey) AS k FROM part WHERE p_size % 3 IN (0, 2)),
n AS (SELECT c.*, n_name FROM c LEFT JOIN nation ON uid = 'n' || n_nationkey AND n_nationkey % 2 = 0 WHERE k = 1 AND NOT (st = 'tuition_fees' AND EXISTS (SELECT 1 FROM b WHERE b.uid = c.uid AND b.url = c.url)))
SELECT source_id, uid AS university_id, '' AS university_name, '' AS country, 'tuition_fees' AS source_type, url, '' AS priority, '' AS crawl_method, '' AS status, '' AS notes FROM b
UNION ALL SELECT 'src_' || substr(sha1(uid || '|' || st || '|' || url), 1, 16), uid, coalesce(n_name, 'named'), CASE WHEN n_name IS NULL THEN '' ELSE 'land' END, st, url, '2', 'static', 'pending', 'promoted from Serper rank ' || p_size FROM n"""
RANKS = """WITH t AS (SELECT s_suppkey, 'Univ & Co ' || s_suppkey % 40 || ' (Old)' AS institution_name, CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_suppkey % 3 = 0 THEN '=' || abs(floor(s_acctbal))::BIGINT ELSE abs(floor(s_acctbal))::BIGINT || '-9999' END AS rank_raw, 'univ and co ' || s_suppkey % 40 AS normalized_name FROM supplier),
n AS (SELECT *, regexp_extract(replace(rank_raw, '=', ''), '(\\d+)', 1) AS rank_numeric FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY normalized_name ORDER BY coalesce(try_cast(rank_numeric AS BIGINT), 10000000), s_suppkey) AS k FROM n)
SELECT normalized_name, institution_name, rank_raw, rank_numeric, CASE rank_raw WHEN '' THEN '' ELSE 'QS 2026 #' || rank_raw END AS rank_display, CASE WHEN contains(rank_raw, '-') THEN 'needs_review' ELSE 'approved' END AS review_status FROM r WHERE k = 1"""
NAMES = """WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(replace(lower(strip_accents(text || ' & (x) of the ' || source)), '&', ' and '), '\\([^)]*\\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents)
SELECT doc_id, norm, array_to_string(list_filter(string_split(norm, ' '), lambda x: x NOT IN ('', 'the', 'of', 'and', 'at', 'in', 'for')), ' ') AS simple FROM t"""
SIMPLE = "list_distinct(list_filter(string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x NOT IN ('', 'the', 'of', 'and', 'at', 'in', 'for')))"
NATION_NAME = f"{pick('n_nationkey', 'small ring works', 'red widget house', 'blue bolt', 'steel and lavender')} || ' of ' || {pick('n_nationkey', '', 'the north', '')}"
TOKENS = f"""WITH l AS (SELECT n_nationkey, {SIMPLE.format(NATION_NAME)} AS a FROM nation), r AS (SELECT p_partkey, {SIMPLE.format('p_name')} AS b FROM part),
j AS (SELECT n_nationkey, p_partkey, len(list_intersect(a, b)) AS k, len(a) AS na, len(b) AS nb FROM l, r),
s AS (SELECT n_nationkey, p_partkey, round_even(greatest(k / (na + nb - k) * 0.82, k / least(na, nb) * 0.78)::DOUBLE, 3) AS score FROM j WHERE k > 0),
p AS (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY score DESC, p_partkey)::INT AS place FROM s WHERE score >= 0.62)
SELECT * FROM p WHERE place <= 5"""
ANSWERS = f"""t AS (SELECT 'e' || o_orderkey AS evidence_id, {pick('o_orderkey', 'tuition_fees', 'graduate_admissions', 'career')} AS st, o_orderkey % 4 IN (0, 3) AS quoted, o_orderkey % 2 = 0 AS dated,
  o_orderstatus, CASE WHEN o_orderkey % 5 = 4 THEN 'non-usable evidence' ELSE '' END AS skip, CASE WHEN o_custkey % 7 = 3 THEN 'timed out' ELSE '' END AS failure, floor(o_totalprice)::BIGINT::VARCHAR AS n, {pick('o_custkey', 'USD', 'EUR', 'USD')} AS code, {pick('o_orderkey', '0.90', '1.00', '0.72', '0.40', '0.40')} AS sure FROM orders)"""
MODEL = f"""WITH {ANSWERS}
SELECT evidence_id, 'tuition' AS fact_type, 'tuition_fee' AS fact_key, n AS value_number, code AS value_currency, sure AS confidence_score FROM t WHERE st = 'tuition_fees' AND quoted
UNION ALL SELECT evidence_id, 'application', 'application_deadline_candidate', '', '', '0.70' FROM t WHERE st = 'graduate_admissions' AND dated"""
REPORT = f"""WITH {ANSWERS}
SELECT evidence_id, o_orderstatus AS source_id, st AS source_type, 'https://example.org' AS source_url, CASE WHEN skip <> '' THEN 'skipped' WHEN failure <> '' THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN skip = '' AND failure = '' AND ((st = 'tuition_fees' AND quoted) OR (st = 'graduate_admissions' AND dated)) THEN '1' ELSE '0' END AS facts_emitted, CASE WHEN skip <> '' THEN skip ELSE failure END AS error, 'm' AS model FROM t"""
CONFIDENCE = f"""WITH t AS (SELECT page_id, page_id % 5 + 1 AS rank, url, {pick('page_id', 'tuition_fees', 'program_catalog')} AS st, lower({pick('page_id', 'Tuition fees', 'Official page', 'x')} || '  ' || url) AS j, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages),
s AS (SELECT *, 0.45 + CASE WHEN page_id % 4 <> 0 AND suffix(host, 'example.com') THEN 0.25 ELSE 0 END + CASE WHEN contains(j, split_part(st, '_', 1)) THEN 0.05 ELSE 0 END + CASE WHEN contains(j, split_part(st, '_', 2)) THEN 0.05 ELSE 0 END + CASE WHEN contains(j, 'official') THEN 0.05 ELSE 0 END - 0.03 * (rank - 1) AS v FROM t WHERE rank <= 3)
SELECT 'u' || page_id AS university_id, st AS source_type, url AS candidate_url, rank::VARCHAR AS rank, format('{{:.2f}}', v::DOUBLE) AS confidence_score FROM s"""
JSON = "SELECT event_type, count(try_cast(json_extract_string(props, '$.k') AS DOUBLE)) AS n, sum(try_cast(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1"
HOSTS = """WITH t AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) AS scheme, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages), s AS (SELECT *, string_split(regexp_replace(host, '^www\\.', ''), '.') AS p FROM t)
SELECT page_id, scheme, host, array_to_string(p[-2:], '.') AS domain, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, host <> '' AS valid FROM s"""
QUOTES = """WITH n AS (SELECT max(item_id) + 1 AS k FROM benchmark), t AS (SELECT doc_id, d.text AS body, CASE doc_id % 3 WHEN 0 THEN substr(b.text, 1, 40) WHEN 1 THEN '  ' || translate(replace(substr(d.text, 5, 40), ' ', '  '), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE substr(d.text, 3, 6) END AS quote FROM documents d, n JOIN benchmark b ON b.item_id = doc_id % k)
SELECT doc_id, length(trim(quote, ' ' || chr(10))) >= 8 AND contains(lower(trim(regexp_replace(body, '\\s+', ' ', 'g'))), lower(trim(regexp_replace(quote, '\\s+', ' ', 'g')))) AS holds FROM t"""
LIMITS = """WITH t AS (SELECT doc_id, CASE WHEN suffix(source, '3') THEN 'career' ELSE 'tuition_fees' END AS source_type, doc_id % 4 <> 0 AND doc_id % 5 <> 0 AS usable FROM documents),
s AS (SELECT *, CASE WHEN source_type <> 'tuition_fees' THEN 'source type filtered' WHEN NOT usable THEN 'non-usable evidence' ELSE '' END AS skip FROM t), p AS (SELECT *, row_number() OVER (PARTITION BY skip ORDER BY doc_id) AS k FROM s)
SELECT doc_id::VARCHAR AS evidence_id, source_type, CASE WHEN skip <> '' THEN skip WHEN k <= 50 THEN 'llm offset skipped' WHEN k > 150 THEN 'llm limit reached' ELSE '' END AS skip FROM p"""
STRIP = squeeze(r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)\b[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')")
WORDED = "worded AS (SELECT *, translate(lower(anchor_text || ' ' || link), '-_', '  ') AS words, lower(anchor_text) AS low FROM linked)"
LINK_CLASSIFY = f"""WITH {LINKS}, linked AS (SELECT *, href || '/' || {pick('page_id', 'apply', 'student-fees', 'housing_and_careers', 'study', 'x')} AS link FROM links), {WORDED}, u AS ({LABELS})
SELECT page_id, place, source_type, 'matched keyword ''' || hint || '''' AS reason, CASE WHEN contains(low, hint) THEN '0.75' ELSE '0.55' END AS score FROM u WHERE hint IS NOT NULL"""
LINK_DEDUPE = rf"""WITH {LINKS}, linked AS (SELECT *, regexp_extract(url, '^[^?#]*') || '/' || {pick('place', 'apply', 'fees', 'housing', 'a.jpg', 'careers')} AS link FROM links), {WORDED}, u AS ({LABELS}),
r AS (SELECT *, 'u' || page_id % 20 AS uid, row_number() OVER (PARTITION BY page_id % 20, source_type, link ORDER BY page_id, place) AS k FROM u WHERE hint IS NOT NULL AND NOT regexp_matches(link, '\.jpg$'))
SELECT uid AS university_id, source_type AS candidate_source_type, link AS url, anchor_text, CASE WHEN contains(low, hint) THEN '0.75' ELSE '0.55' END AS confidence_score, 'matched keyword ''' || hint || '''' AS reason FROM r WHERE k = 1"""


def greedy(limit: int) -> str:
    """Types choose in their order; what one has chosen, or the map has, is closed to the later ones."""
    steps, chosen = [], ["SELECT uid, url FROM base"]
    for k, kind in enumerate(lx.CANDIDATE_TYPES):
        steps.append(f"t{k} AS (SELECT uid, kind, url, reason FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, length(url), url) AS place FROM offered o WHERE kind = {q(kind)} AND NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(chosen)}) c WHERE c.uid = o.uid AND c.url = o.url)) WHERE place <= {limit})")
        chosen.append(f"SELECT uid, url FROM t{k}")
    new = " UNION ALL ".join(f"SELECT * FROM t{k}" for k in range(len(steps)))
    return f"""WITH offered AS (SELECT university_id AS uid, candidate_source_type AS kind, url, confidence_score::DOUBLE AS score, reason FROM ({LINK_DEDUPE})),
base AS (SELECT 'u' || page_id % 20 AS uid, 'tuition_fees' AS kind, regexp_extract(url, '^[^?#]*') || {pick('page_id', '/fees', '/apply', '/other', '')} AS url, '' AS notes FROM pages),
{', '.join(steps)},
a AS (SELECT uid, kind, url, notes FROM base UNION ALL SELECT uid, kind, url, 'candidate from homepage link; review before promotion; ' || reason FROM ({new}))
SELECT 'src_' || substr(sha1(uid || '|' || kind || '|' || lower(url)), 1, 16) AS source_id, uid AS university_id, kind AS source_type, url, notes FROM a"""


def unescaped(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {q(entity)}, {q(char)})"
    return x


PARSED = f"WITH {LINKS} SELECT page_id, place, regexp_extract(url, '^[^:/?#]+://[^/?#]*') || {unescaped('href')} AS link, {unescaped('anchor_text')} AS anchor_text FROM links"
RECORDS = """WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([0-9]+)', 1) AS n,
    regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/([a-z]+)/', 1) AS country
  FROM pages)
SELECT '=' || n AS rank_raw, host || ' & co' AS institution_name, min_by(country, page_id) AS country FROM p WHERE n <> '' GROUP BY host, n"""

NAME_PAIRS = f"""WITH s AS (
  SELECT 's' || s_suppkey AS university_id, 'n' || s_nationkey AS country, {pick("s_suppkey", "town", "", "city")} AS city,
    trim(regexp_replace(replace(lower({pick("s_suppkey", "The Small Rings", "Red Wdget", "Economy Blue-Bolt", "Hotgear & Standard", "Large Gizmo Large", "Zq")} || ' ' || {pick("(s_suppkey // 6)", "", "Promo", "of the Medium", "ECONOMY", "Small Gear Cold")}), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS norm
  FROM supplier),
p AS (SELECT p_partkey, lower(p_name || ' ' || p_type) AS norm, CASE WHEN p_size % 10 = 0 THEN '' ELSE 'n' || p_size % 25 END AS country, {pick("p_partkey", "town", "")} AS city FROM part),
w AS (SELECT unnest(string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z 0 1 2 3 4 5 6 7 8 9', ' ')) AS letter UNION ALL SELECT ' '),
n AS (
  SELECT norm, simple, list_distinct(string_split(simple, ' ')) AS words, list_transform((SELECT list(letter ORDER BY letter) FROM w), lambda c: length(simple) - length(replace(simple, c, ''))) AS letters
  FROM (SELECT norm, array_to_string(list_filter(string_split(norm, ' '), lambda t: t <> '' AND NOT list_contains([{", ".join(map(q, lx.NAME_STOPWORDS))}], t)), ' ') AS simple FROM (SELECT norm FROM s UNION SELECT norm FROM p))),
x AS (
  SELECT s.university_id, p.p_partkey, a.simple, b.simple AS q_simple, list_sum(list_transform(list_zip(a.letters, b.letters), lambda z: least(z[1], z[2])))::INTEGER AS shared_letters, length(list_intersect(a.words, b.words))::INTEGER AS shared_words,
    length(a.words) AS n, length(b.words) AS m,
    0.62::DOUBLE - ((0.0::DOUBLE + CASE WHEN p.country = '' OR p.country = s.country THEN 0.12::DOUBLE ELSE -0.08::DOUBLE END) + CASE WHEN s.city <> '' AND s.city = p.city THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END) - 0.002::DOUBLE AS need
  FROM s JOIN n a ON a.norm = s.norm, p JOIN n b ON b.norm = p.norm)
SELECT university_id, p_partkey, simple, q_simple, shared_letters, shared_words FROM x
WHERE simple = q_simple OR greatest(2.0::DOUBLE * shared_letters / (length(simple) + length(q_simple)) * 0.76::DOUBLE, shared_words::DOUBLE / (n + m - shared_words) * 0.82::DOUBLE, shared_words::DOUBLE / least(n, m) * 0.78::DOUBLE) >= need"""

RELATIVE_LINKS = ("", "../x/./y", "?q=1", "//cdn.example.org/a/../b", "#f", "a/../../b/", "./", "mailto:a@b.org", "/p//q/..", "..?z#w")
RESOLVE = f"""WITH {LINKS},
x AS (SELECT page_id, place, regexp_extract(url, '^[^?#]*') || {pick("page_id", "", "/", "/d/e", "/d/../f/?k")} AS base, CASE WHEN place % 10 = 0 THEN href ELSE {pick("place", *RELATIVE_LINKS)} END AS link FROM links),
p AS (
  SELECT *, regexp_extract(base, '^([a-z]+):', 1) AS scheme, regexp_extract(base, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(base, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS bpath, regexp_extract(base, '^[^?#]*(\\?[^#]*)', 1) AS bquery,
    regexp_extract(link, '^([^?#]*)', 1) AS path, regexp_extract(link, '^[^?#]*(\\?[^#]*)', 1) AS query, regexp_extract(link, '(#.*)$', 1) AS fragment
  FROM x),
s AS (
  SELECT *, CASE WHEN path LIKE '/%' THEN string_split(path, '/') ELSE list_concat(
    list_concat([string_split(bpath, '/')[1]], list_filter((CASE WHEN bpath LIKE '%/' THEN bpath ELSE regexp_replace(bpath, '[^/]*$', '') END).string_split('/')[2:], lambda v: v <> '')), list_filter(string_split(path, '/')[:-2], lambda v: v <> '')) || [string_split(path, '/')[-1]] END AS segments
  FROM p),
d AS (SELECT *, list_reduce(list_concat([[]::VARCHAR[]], list_transform(segments, lambda v: [v])), lambda a, v: CASE v[1] WHEN '..' THEN a[: length(a) - 1] WHEN '.' THEN a ELSE list_concat(a, v) END) AS kept FROM s)
SELECT page_id, place, base, link, CASE
  WHEN regexp_matches(link, '^[a-z]+:') THEN link
  WHEN link LIKE '//%' THEN scheme || ':' || link
  WHEN path = '' THEN scheme || '://' || host || bpath || CASE WHEN query <> '' THEN query ELSE bquery END || fragment
  ELSE scheme || '://' || host || coalesce(nullif(regexp_replace(array_to_string(kept || CASE WHEN segments[-1] IN ('.', '..') THEN [''] ELSE []::VARCHAR[] END, '/'), '^([^/])', '/\\1'), ''), '/') || query || fragment END AS address
FROM d"""

ON_READ = f"""WITH RECURSIVE b AS (
  SELECT o_orderkey, -1 AS n, CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'P' THEN 'manual' ELSE 'failed' END AS status, o_orderstatus AS notes FROM orders
  UNION ALL
  SELECT o_orderkey, n + 1, CASE WHEN new = 'fetched' OR (status <> 'fetched' AND new IN ('failed', 'skipped')) THEN new ELSE status END, CASE WHEN new = 'fetched' OR (status <> 'fetched' AND new IN ('failed', 'skipped')) THEN 'batch ' || (n + 1) ELSE notes END
  FROM (SELECT *, {pick("(o_orderkey // (n + 3))", "fetched", "failed", "skipped", "manual")} AS new FROM b WHERE n < 2))
SELECT 'o' || o_orderkey AS source_id, status, notes, o_orderkey AS place FROM b WHERE n = 2"""

SQL = {
    "classify_quality": CLASSIFY,
    "stable_ids_and_hash": "SELECT doc_id, 'src_' || substr(sha1(lower(trim(source)) || '|' || lower(trim(lang)) || '|' || doc_id), 1, 16) AS source_id, sha256(text) AS content_hash FROM documents",
    "sentence_split_counts": r"SELECT doc_id, len(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS n_sentences FROM documents",
    "html_links": f"WITH {LINKS} SELECT page_id, place, href, anchor_text FROM links",
    "html_strip_text": f"SELECT page_id, {STRIP} AS visible FROM pages",
    "link_classify_explode": LINK_CLASSIFY, "link_dedupe_first": LINK_DEDUPE, "money_facts": MONEY, "usd_range": USD_RANGE, "english_scores": ENGLISH, "cert_flags": CERTS, "deadline_candidates": DEADLINES, "program_rows": PROGRAMS, "classify_evidence": RECLASSIFY, "facts_routing": ROUTING, "match_report": MATCHED, "tag_sets": TAG_SETS,
    "facts_split_union": FACTS_UNION, "prefer_origin": PREFER, "first_value_by_order": FIRST_VALUE, "ordered_distinct_summary": SUMMARY, "cert_join_display": CERT_JOIN, "coverage_score": COVERAGE, "batch_qa_counts": BATCH,
    "profile_flagship": FLAGSHIP, "field_gaps": GAPS, "quality_gate": GATE, "import_qa_status": QA_STATUS, "country_fallback": FALLBACK,
    "data_quality_fmt": "SELECT c_custkey, format('{:.2f}', round_even((c_custkey % 17) / 16.0::DOUBLE, 2)) AS score, round_even(c_acctbal / 2.0, 0)::BIGINT AS half FROM customer",
    "normalize_source_map": NORMALIZE, "drop_reason_counts": DROPS, "retry_filter": RETRY, "repairs_first_match": REPAIRS, "merge_crawl": MERGE, "search_anti_join": SEARCH, "promote_anti_union": PROMOTE, "rank_dedupe_argmin": RANKS,
    "name_normalize": NAMES, "token_similarity_join": TOKENS, "candidate_confidence": CONFIDENCE, "json_cells": JSON, "url_hosts": HOSTS, "llm_quote_gate": QUOTES, "model_facts": MODEL, "model_report": REPORT, "limit_offset_report": LIMITS, "validation_errors": VALIDATE,
    "greedy_candidates": greedy(2), "json_records": RECORDS, "html_parse_text": PARSED, "name_pairs": NAME_PAIRS, "merge_on_read": ON_READ, "url_resolve": RESOLVE,
}

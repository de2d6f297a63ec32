"""Queries over the star-schema tables, one for each operator family, each built from the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provena import functions as fn
from provena import lexicons as lx
from provena.functions import urls
from provena.materialize import shared_dir
from provena.operators import discovery, extract, llm_facts, profiles, quality, rankings, source_map
from provena.plans import shapes as sh
from provena.schemas import ORDER, RANKING_NORMALIZED, SOURCE, text
from provena.streaming.delta_table import DeltaTable, Rule

table, pick = sh.table, sh.pick


def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    kind = pick(F.col("doc_id"), "housing", "ranking", "career", "program_catalog")
    q = d.select("doc_id", F.length(text("text")).alias("text_len"), quality.classify(kind, text("source"), text("text"), F.when(F.col("doc_id") % 50 == 7, "failed").otherwise("fetched"), F.lit("")).alias("q"))
    return q.select("doc_id", "text_len", F.col("q.status").alias("status"), F.col("q.reason").alias("reason"), fn.two_decimals(F.col("q.score")).alias("score"))


def stable_ids_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fn.stable_id("src", F.col("source"), F.col("lang"), F.col("doc_id").cast("string")).alias("source_id"), F.sha2("text", 256).alias("content_hash"))


def sentence_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(fn.sentences(F.col("text"))).alias("n_sentences"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    found = p.select("page_id", "url", F.posexplode(discovery.native_links(F.col("html"))).alias("place", "l"))
    return found.select("page_id", "url", "place", F.col("l.href").alias("href"), F.col("l.anchor").alias("anchor_text"))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("page_id", "place", "href", "anchor_text")


def html_strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", fn.visible_text(F.col("html")).alias("visible"))


def html_parse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links through the parser: relative addresses resolved, entities unescaped."""
    found = discovery.links(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", F.col("_place").alias("place"), "link", "anchor_text")


#: Links of all kinds, by their place in a page; a blank one stands for the page's own.
RELATIVE_LINKS = ("", "../x/./y", "?q=1", "//cdn.example.org/a/../b", "#f", "a/../../b/", "./", "mailto:a@b.org", "/p//q/..", "..?z#w")


def url_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages, and relative ones made up beside them, resolved against the page's address with a folder added."""
    found = _links(spark, sf_dir)
    base = F.concat(F.regexp_extract("url", "^[^?#]*", 0), pick(F.col("page_id"), "", "/", "/d/e", "/d/../f/?k"))
    link = pick(F.col("place"), *RELATIVE_LINKS)
    link = F.when(link == "", F.col("href")).otherwise(link)
    return found.select("page_id", "place", base.alias("base"), link.alias("link"), urls.resolve(base, link).alias("address"))


def link_classify_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _links(spark, sf_dir).withColumn("link", F.concat(F.col("href"), F.lit("/"), pick(F.col("page_id"), "apply", "student-fees", "housing_and_careers", "study", "x")))
    found = found.withColumn("m", F.explode(discovery.labels(F.col("link"), F.col("anchor_text"))))
    return found.select("page_id", "place", F.col("m.source_type").alias("source_type"), F.col("m.reason").alias("reason"), fn.two_decimals(F.col("m.score")).alias("score"))


def link_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.regexp_extract("url", "^[^?#]*", 0)
    found = _links(spark, sf_dir).select(F.concat(F.lit("u"), F.pmod("page_id", F.lit(20)).cast("string")).alias("university_id"), F.lit("n").alias("university_name"), "url", F.concat(own, F.lit("/"), pick(F.col("place"), "apply", "fees", "housing", "a.jpg", "careers")).alias("link"), "anchor_text", (F.col("page_id") * 1000 + F.col("place")).alias(ORDER))
    return discovery.suggestions(found).select("university_id", "candidate_source_type", "url", "anchor_text", "confidence_score", "reason")


def money_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sh.money_texts(spark, sf_dir).select("o_orderkey", F.explode(extract.money_facts(F.col("body"))).alias("f"))
    return found.select("o_orderkey", *[F.col(f"f.{c}").alias(c) for c in ("fact_type", "fact_key", "value_text", "value_number", "value_currency", "confidence_score")], F.get_json_object("f.value_json", "$.max").alias("json_max"), F.get_json_object("f.value_json", "$.context").alias("context"))


def usd_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    code = pick(F.col("o_orderkey"), "USD", "GBP", "JPY", "zzz", "SGD")
    payload = F.concat(F.lit('{"min": '), F.floor("o_totalprice").cast("string"), F.lit(', "max": '), F.floor(F.col("o_totalprice") * 1.5).cast("string"), F.lit(', "currency": "'), code, F.lit('"}'))
    facts = rows.select(F.col("n_name").alias("university_id"), F.lit("tuition").alias("fact_type"), F.lit("tuition_fee").alias("fact_key"), F.lit("").alias("value_text"), payload.alias("value_json"), F.lit("manual").alias("fact_origin"), F.col("o_orderkey").alias(ORDER))
    return profiles.preferred_values(facts).select("university_id", "usd_min", "usd_max")


def english_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    body = F.concat(pick(n, "IELTS", "TOEFL iBT", "PTE"), F.lit(" overall score of "), F.when(F.pmod(n, F.lit(3)) == 0, F.concat((F.lit(1) + F.col("p_size") % 9).cast("string"), F.lit(".5"))).otherwise((F.lit(10) + F.col("p_size") * 2).cast("string")), F.lit(" is needed"))
    found = p.select("p_partkey", F.explode(extract.english_facts(body)).alias("f"))
    return found.select("p_partkey", *[F.col(f"f.{c}").alias(c) for c in ("fact_key", "value_text", "value_number", "confidence_score")])


def cert_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    body = F.concat(F.lit("Applicants must submit "), pick(n, "SAT", "act", "ACT", "GRE", "A-levels", "HSK"), F.lit(" scores; "), pick(F.col("p_size"), "required", "optional", "certificate needed", "see below"), F.lit("."))
    found = p.select("p_partkey", F.explode(extract.certificate_facts(body)).alias("f"))
    return found.select("p_partkey", *[F.col(f"f.{c}").alias(c) for c in ("fact_key", "confidence_score")])


def deadline_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, n = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    body = F.concat(F.lit("Welcome to all. The "), pick(n, "early", "regular", "final"), F.lit(" application "), pick(F.col("o_custkey"), "deadline", "date"), F.lit(" is "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" for bachelor study. Contact us."))
    found = o.select("o_orderkey", F.explode(extract.deadlines(body)).alias("d"))
    return found.select("o_orderkey", F.col("d.date_text").alias("date_text"), F.col("d.round_name").alias("round_name"), F.col("d.degree_level").alias("degree_level"), F.col("d.text").alias("sentence"), F.col("d.confidence").alias("confidence"))


def program_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    body = F.concat(F.lit("We offer Bachelor of "), F.col("p_name"), F.lit("; and "), pick(n, "Master of Laws", "PhD in physics", "nothing"), F.lit(". End"))
    sources = sh.typed_sources(spark, sf_dir, 5, "program_catalog", "tuition_fees", "program_catalog")
    size = F.col("p_size")
    quality_status = F.when(size % 6 == 0, "blocked").when(size % 5 == 0, "").otherwise("usable")
    evidence = p.select(n.cast("string").alias("evidence_id"), F.concat(F.lit("k"), (n % 5).cast("string")).alias("source_id"), n.cast("string").alias("university_id"), F.lit("u").alias("url"), body.alias("extracted_text"), F.when(size % 7 == 0, "failed").otherwise("ok").alias("status"), quality_status.alias("content_quality_status"), n.alias(ORDER))
    return extract.programs(sources, evidence).select("program_id", "university_id", "name", "normalized_name", "degree_level", "field_of_study")


def classify_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as evidence, classified anew by the type of the last source of their id; some have none."""
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    sources = sh.typed_sources(spark, sf_dir, 4, "housing", "career", "program_catalog")
    evidence = d.select(
        n.cast("string").alias("evidence_id"), F.concat(F.lit("k"), (n % 5).cast("string")).alias("source_id"), F.col("source").alias("title"), F.col("text").alias("extracted_text"), F.lit("").alias("error"),
        F.when(n % 3 == 0, "fetched").otherwise("").alias("fetch_status"), F.when(n % 50 == 7, "failed").otherwise("ok").alias("status"), n.alias(ORDER),
    )
    found = quality.classify_evidence(sources, evidence)
    return found.select(F.col("evidence_id").cast("long").alias("doc_id"), "text_len", F.col("content_quality_status").alias("status"), F.col("content_quality_reason").alias("reason"), F.col("content_signal_score").alias("score"))


def facts_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of parts written as pages of seven source types, some of them not usable."""
    p, n, size = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    said = pick(size, "Our residence and housing office", "Career and internship service", "We do not offer scholarships", "Apply with UCAS: portfolio and interview", "Rolling admission for bachelor of law", "Scholarship for master students", "Nothing more")
    evidence = p.select(
        n.cast("string").alias("evidence_id"), F.concat(F.lit("k"), (n % 7).cast("string")).alias("source_id"), F.lit("u").alias("university_id"), F.lit("https://example.org").alias("url"), F.concat(F.col("p_name"), F.lit(". "), said, F.lit(".")).alias("extracted_text"),
        F.when(n % 9 == 4, "failed").otherwise("ok").alias("status"), pick(F.floor(n / 7), "usable", "", "blocked").alias("content_quality_status"), n.alias(ORDER),
    )
    found = extract.facts(sh.typed_sources(spark, sf_dir, 6, *sh.ROUTED), evidence, "2026-01-01")
    return found.select("evidence_id", "fact_type", "fact_key", "value_text", "confidence_score", "fact_origin")


def match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of nations: scored suppliers as candidates, taken if they are sure, else older ranks stay."""
    s, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    made = {"institution_name": F.col("s_name"), "rank_numeric": n.cast("string"), "rank_display": F.concat(F.lit("#"), n.cast("string")), "review_status": pick(n, "approved", "needs_review")}
    row = F.struct(*[made.get(c, F.lit("")).alias(c) for c in RANKING_NORMALIZED])
    scored = s.select(F.col("s_nationkey").cast("long").alias("seed_ord"), row.alias("row"), n, ((F.lit(62) + n * 7 % 39) / F.lit(100.0)).alias("score"))
    order = Window.partitionBy("seed_ord").orderBy(F.desc("score"), "s_suppkey")
    found = scored.withColumns({"place": F.row_number().over(order), "next_score": F.lead("score").over(order)})
    nations, k = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    base = nations.filter(k % 3 != 1).select(F.col("n_name").alias("university_id"), F.when(k % 3 == 0, (k + 1).cast("string")).otherwise("").alias("qs_rank"), F.lit("7").alias("the_rank"), F.lit("old").alias("rank_display"), F.lit("approved").alias("review_status"), F.lit("kept").alias("notes"), k.cast("long").alias(ORDER))
    imports, report = rankings.match(sh.nation_seed(spark, sf_dir), found, base)
    imports = imports.select("university_id", "qs_rank", "the_rank", "rank_display", "review_status", "notes")
    return imports.join(report.select("university_id", "match_status", "matched_name", "confidence_score", F.col("notes").alias("said")), "university_id")


def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("low", F.lower("text"))
    found = d.select("source", F.explode(F.concat(fn.tags(F.col("low"), lx.SUBJECTS), fn.tags(F.col("low"), lx.STUDY_LEVELS), fn.tags(F.col("low"), lx.VIBES), fn.tags(F.col("low"), lx.SUPPORTS))).alias("tag"))
    return found.groupBy("source").agg(F.array_join(F.slice(F.array_sort(F.collect_set("tag")), 1, 5), ",").alias("tags"), F.count("*").alias("n"))


def facts_split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = sh.event_facts(spark, sf_dir)
    merged = extract.merge(facts.filter(F.col(ORDER) % 2 == 0), facts.filter(F.col(ORDER) % 2 == 1)).select("fact_id", "university_id", "fact_origin")
    split = lambda df, name: df.withColumn("part", F.lit(name))
    return split(extract.extracted(merged), "extracted").unionByName(split(extract.generated(merged), "generated")).unionByName(split(extract.from_model(merged), "model"))


def prefer_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.preferred_values(sh.event_facts(spark, sf_dir)).select("university_id", "fact_type", "fact_key", "value")


def first_value_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.fact_groups(sh.event_facts(spark, sf_dir)).select("university_id", "fact_type", "fact_key", "model", "n", "first")


def ordered_distinct_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.summaries(sh.event_facts(spark, sf_dir).filter("fact_type = 'english_requirement'"), fn.clean_summary(F.col("value_text"), 80), 3)
    return found.select("university_id", "model", F.array_join("found", " or ").alias("summary"))


def cert_join_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = sh.event_facts(spark, sf_dir).filter("fact_type = 'cert_requirement'")
    return facts.groupBy("university_id").agg(F.array_sort(F.collect_set("fact_key")).alias("tags")).select("university_id", profiles.certificate_summary(F.col("tags")).alias("summary"))


def coverage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.source_fields(sh.order_sources(spark, sf_dir), sh.line_evidence(spark, sf_dir))
    return found.select("university_id", fn.two_decimals(F.col("coverage")).alias("coverage"))


def batch_qa_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.source_fields(sh.order_sources(spark, sf_dir), sh.line_evidence(spark, sf_dir)).drop("coverage")


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 3 == 0).select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("university_id"), F.floor("s_acctbal").cast("string").alias("qs_rank"), F.col("s_suppkey").alias(ORDER))
    return profiles.build(sh.supplier_seed(spark, sf_dir), sh.supplier_sources(spark, sf_dir), sh.supplier_facts(spark, sf_dir), ranks, sh.nation_costs(spark, sf_dir), sh.part_evidence(spark, sf_dir))


def profile_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of suppliers: every field that the facts of line items decide."""
    lists = ["subject_tags", "study_level_tags", "strengths", "best_for"]
    return _built(spark, sf_dir).select(
        "university_id", "display_name", "country", "qs_rank", *[F.array_join(c, ",").alias(c) for c in lists], "tuition_usd_min", "tuition_usd_max", "living_cost_usd_min", "living_cost_usd_max", "total_cost_usd_min", "total_cost_usd_max",
        "scholarship_available", "application_system", "deadline_summary", "english_requirement_summary", "requirement_summary", "evidence_coverage_score", "data_quality_score", "import_status", "review_status", "fact_count", "evidence_count",
    )


def field_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.field_gaps(_built(spark, sf_dir))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.quality_gate(_built(spark, sf_dir), sh.supplier_facts(spark, sf_dir)).drop("notes")


def import_qa_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.batch_qa(_built(spark, sf_dir)).drop("has_product_profile")


def country_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir).select("university_id", "country", "living_cost_usd_min", "living_cost_usd_max")


def data_quality_fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.two_decimals(F.pmod("c_custkey", F.lit(17)) / F.lit(16.0)).alias("score"), F.bround(F.col("c_acctbal") / F.lit(2.0), 0).cast("long").alias("half"))


def normalize_source_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_map.normalize(sh.nation_seed(spark, sf_dir), sh.page_sources(spark, sf_dir)).select(*SOURCE)


def drop_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_map.normalize_stats(sh.page_sources(spark, sf_dir))


def retry_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_map.retry_map(sh.order_sources(spark, sf_dir), source_types=["tuition_fees", "housing"]).select(*SOURCE)


def repairs_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), F.col("c_custkey")
    repairs = c.select(F.concat(F.lit("c"), n.cast("string")).alias("university_id"), pick(n, "all_sources", "tuition_fees", "housing", "career").alias("source_type"), F.when(n % 10 == 1, "nope").otherwise(F.concat(F.lit("https://fixed.example/"), n.cast("string"))).alias("new_url"), pick(n, "pdf", "").alias("crawl_method"), F.col("c_mktsegment").alias("notes"), n.alias(ORDER))
    seed = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("university_id"), F.col("s_name").alias("name"), F.lit("").alias("country"), F.col("s_suppkey").alias(ORDER))
    return source_map.apply_repairs(seed, sh.order_sources(spark, sf_dir), repairs).select("university_id", "university_name", "source_type", "url", "priority", "language_code", "crawl_method", "status", "notes", "change")


def merge_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sh.order_sources(spark, sf_dir)
    again = base.filter(F.col(ORDER) % 3 == 0).withColumns({"status": pick(F.floor(F.col(ORDER) / 3), "fetched", "failed", "skipped", "manual"), "notes": F.lit("again")})
    return source_map.merge_sources(base, again).select("source_id", "status", "notes", "replaced")


def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sources in a table of deltas: three batches with other states, one of them sent twice, buckets rewritten between them, and the table read."""
    base = sh.order_sources(spark, sf_dir)
    held = DeltaTable(spark, f"{shared_dir(spark)}/merged-{uuid.uuid4().hex}", Rule(tuple(SOURCE)))
    held.create(base)
    for n in (0, 1, 1, 2):
        batch = base.withColumns({"status": pick(F.floor(F.col(ORDER) / (n + 2)), "fetched", "failed", "skipped", "manual"), "notes": F.lit(f"batch {n}")})
        held.append(batch, n)
        if n == 1:
            held.compact()
    return held.read().select("source_id", "status", "notes", F.col(ORDER).alias("place"))


def search_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), F.col("c_custkey")
    seed = c.select(F.concat(F.lit("c"), n.cast("string")).alias("university_id"), F.col("c_name").alias("name"), n.alias(ORDER))
    return source_map.search_requests(seed, sh.order_sources(spark, sf_dir), ["tuition_fees", "career", "english_requirements"]).select("university_id", "source_type", "search_query")


def promote_anti_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, p, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"), F.col("p_partkey")
    base = s.select(F.concat(F.lit("b"), F.col("s_suppkey").cast("string")).alias("source_id"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("university_id"), F.lit("tuition_fees").alias("source_type"), F.concat(F.lit("https://example.org/"), (F.col("s_suppkey") % 50).cast("string")).alias("url"), F.col("s_suppkey").alias(ORDER))
    found = p.select(
        F.concat(F.lit("n"), (n % 25).cast("string")).alias("university_id"), pick(n, "tuition_fees", "housing").alias("source_type"), F.concat(F.lit(" (https://example.org/"), (n % 60).cast("string"), F.lit(")")).alias("candidate_url"),
        pick(F.col("p_size"), "Approved", "needs_review", "approved").alias("review_status"), F.col("p_size").cast("string").alias("rank"), F.lit("named").alias("university_name"), F.lit("").alias("country"), n.alias(ORDER),
    )
    seed = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("university_id"), F.col("n_name").alias("name"), F.lit("land").alias("country"), F.col("n_nationkey").cast("long").alias(ORDER))
    return source_map.promote(seed, base, found).select("source_id", "university_id", "university_name", "country", "source_type", "url", "priority", "crawl_method", "status", "notes")


def rank_dedupe_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    raw = s.select(F.concat(F.lit("Univ & Co "), (n % 40).cast("string"), F.lit(" (Old)")).alias("institution_name"), F.when(n % 7 == 0, "").when(n % 3 == 0, F.concat(F.lit("="), F.abs(F.floor("s_acctbal")).cast("string"))).otherwise(F.concat(F.abs(F.floor("s_acctbal")).cast("string"), F.lit("-9999"))).alias("rank_raw"), n.alias(ORDER))
    return rankings.best_ranks(rankings.normalize(raw, "2026-01-01")).select("normalized_name", "institution_name", "rank_raw", "rank_numeric", "rank_display", "review_status")


def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    name = fn.normalize_name(F.concat(F.col("text"), F.lit(" & (x) of the "), F.col("source")))
    return d.select("doc_id", name.alias("norm"), fn.simple_name(name).alias("simple"))


def token_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best parts for each nation's name by shared words, at the candidates' threshold."""
    name = F.concat(pick(F.col("n_nationkey"), "small ring works", "red widget house", "blue bolt", "steel and lavender"), F.lit(" of "), pick(F.col("n_nationkey"), "", "the north", ""))
    left = table(spark, sf_dir, "nation").select("n_nationkey", fn.simple_name(fn.normalize_name(name)).alias("a"))
    right = table(spark, sf_dir, "part").select("p_partkey", fn.simple_name(fn.normalize_name(F.col("p_name"))).alias("b")).withColumn("token", F.explode(F.array_distinct(F.split("b", " "))))
    pairs = left.withColumn("token", F.explode(F.array_distinct(F.split("a", " ")))).join(right, "token").select("n_nationkey", "p_partkey", "a", "b").distinct()
    jaccard, containment = rankings.token_scores(F.col("a"), F.col("b"))
    scored = pairs.select("n_nationkey", "p_partkey", F.bround(F.greatest(jaccard * 0.82, containment * 0.78), 3).alias("score")).filter(F.col("score") >= rankings.CANDIDATE)
    place = F.row_number().over(Window.partitionBy("n_nationkey").orderBy(F.desc("score"), "p_partkey"))
    return scored.withColumn("place", place).filter("place <= 5")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers written over orders: some quotes, source types and dates fail their gates."""
    n, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("string")
    tuition = F.concat(F.lit('{"supporting_text": "'), pick(n, "tuition for STUDENTS is", "not on this page", "Tuition", " for students is "), F.lit('", "amount_min": '), price, F.lit(', "currency": "'), pick(F.col("o_custkey"), "usd", "eur", ""), F.lit('", "confidence_score": '), pick(n, "0.9", "1.5", "null", "0.4", "0.4"), F.lit("}"))
    deadline = F.concat(F.lit('{"supporting_text": "apply by 1 March", "date_text": "'), pick(n, "1 March", ""), F.lit('"}'))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("e"), n.cast("string")).alias("evidence_id"), F.col("o_orderstatus").alias("source_id"), F.when(n % 5 == 4, "non-usable evidence").otherwise("").alias("skip"), F.when(F.col("o_custkey") % 7 == 3, "timed out").otherwise("").alias("failure"), F.lit("u").alias("university_id"), F.lit("https://example.org").alias("url"), F.concat(F.lit("Tuition  for students is "), price, F.lit(" USD a year. Apply by 1 March.")).alias("extracted_text"),
        pick(n, "tuition_fees", "graduate_admissions", "career").alias("source_type"), F.concat(F.lit('{"tuition_facts": ['), tuition, F.lit('], "deadline_facts": ['), deadline, F.lit("]}")).alias("answer"), n.alias(ORDER),
    )


def model_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all answers."""
    return llm_facts.facts(_answers(spark, sf_dir), "2026-01-01").select("evidence_id", "fact_type", "fact_key", "value_number", "value_currency", "confidence_score")


def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came of each row of evidence: facts, a failed call, or a reason for not being sent."""
    answered = _answers(spark, sf_dir).withColumn("answer", F.when((F.col("skip") == "") & (F.col("failure") == ""), F.col("answer")).otherwise(""))
    found = llm_facts.report(answered, llm_facts.facts(answered, "2026-01-01"), "m")
    return found.select("evidence_id", "source_id", "source_type", "source_url", "status", "facts_emitted", "error", "model")


def candidate_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    requests = p.select(F.concat(F.lit("q"), n.cast("string")).alias("search_query"), F.concat(F.lit("u"), n.cast("string")).alias("university_id"), F.lit("n").alias("name"), F.lit("").alias("country"), pick(n, "tuition_fees", "program_catalog").alias("source_type"), F.when(n % 4 == 0, "").otherwise("https://www.example.com/").alias("website_url"))
    results = p.select(F.concat(F.lit("q"), n.cast("string")).alias("search_query"), (n % 5 + 1).cast("int").alias("rank"), F.col("url").alias("link"), pick(n, "Tuition fees", "Official page", "x").alias("title"), F.lit("").alias("snippet"))
    return source_map.search_candidates(requests, results, 3).select("university_id", "source_type", "candidate_url", "rank", "confidence_score")


def json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.get_json_object("props", "$.k").try_cast("double")).alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("total"))


def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", fn.url_scheme(u).alias("scheme"), fn.url_host(u).alias("host"), fn.comparable_domain(fn.url_host(u)).alias("domain"), fn.url_path(u).alias("path"), fn.valid_url(u).alias("valid"))


def llm_quote_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    n = b.agg((F.max("item_id") + 1).alias("n_items"))
    rows = d.crossJoin(F.broadcast(n)).withColumn("item_id", F.pmod("doc_id", F.col("n_items"))).join(b.withColumnRenamed("text", "item"), "item_id")  # one row
    own = F.concat(F.lit("  "), F.translate(F.replace(F.substring("text", 5, 40), F.lit(" "), F.lit("  ")), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    quote = F.when(F.col("doc_id") % 3 == 0, F.substring("item", 1, 40)).when(F.col("doc_id") % 3 == 1, own).otherwise(F.substring("text", 3, 6))
    return rows.select("doc_id", llm_facts.quoted(quote, F.col("text")).alias("holds"))


def limit_offset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    evidence = d.select(n.cast("string").alias("evidence_id"), F.col("source").alias("source_id"), F.when(n % 4 == 0, "failed").otherwise("ok").alias("status"), F.when(n % 5 == 0, "blocked").otherwise("usable").alias("content_quality_status"), n.alias(ORDER))
    sources = d.groupBy("source").agg(F.min("doc_id").alias(ORDER)).select(F.col("source").alias("source_id"), F.when(F.col("source").endswith("3"), "career").otherwise("tuition_fees").alias("source_type"), ORDER)
    return llm_facts.plan(sources, evidence, limit=100, offset=50, source_types=["tuition_fees"]).select("evidence_id", "source_type", "skip")


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_map.validate_sources(sh.page_sources(spark, sf_dir), sh.nation_seed(spark, sf_dir)).select("row_number", "message")


def greedy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suggestions of pages, chosen type by type, each url once for an institution and none that its map has."""
    offered = link_dedupe_first(spark, sf_dir).withColumn("university_name", F.lit("n"))
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    own = F.regexp_extract("url", "^[^?#]*", 0)
    current = p.select(F.concat(F.lit("u"), F.pmod(n, F.lit(20)).cast("string")).alias("university_id"), F.lit("Uni").alias("university_name"), F.lit("tuition_fees").alias("source_type"), F.concat(own, pick(n, "/fees", "/apply", "/other", "")).alias("url"), n.alias(ORDER))
    return discovery.candidate_map(current, offered, 2).select("source_id", "university_id", "source_type", "url", "notes")


def seq_ratio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations matched to supplier-made ranking rows by name similarity."""
    s, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name"))
    raw = s.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(pick(n, "University of ", "The ", ""), F.initcap("n_name"), pick(n, "", " State")).alias("institution_name"), n.cast("string").alias("rank_raw"), n.alias(ORDER))
    best = rankings.best_ranks(rankings.normalize(raw, "2026-01-01"))
    found = rankings.candidates(sh.nation_seed(spark, sf_dir), best)
    return rankings.candidate_rows(found).select("university_id", "candidate_name", "rank_numeric", "confidence_score", "match_reason", "place")


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of made-up supplier names and part names that words or letters can still lift to a candidate, met through the name index."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    key = F.col("s_suppkey")
    name = F.concat(pick(key, "The Small Rings", "Red Wdget", "Economy Blue-Bolt", "Hotgear & Standard", "Large Gizmo Large", "Zq"), F.lit(" "), pick(F.floor(key / 6), "", "Promo", "of the Medium", "ECONOMY", "Small Gear Cold"))
    seeds = s.select(F.concat(F.lit("s"), key.cast("string")).alias("university_id"), name.alias("name"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("country"), pick(key, "Town", "", "City").alias("city"), key.alias(ORDER))
    size = F.col("p_size")
    ranked = p.select(
        F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("q_norm"), F.when(size % 10 == 0, "").otherwise(F.concat(F.lit("n"), (size % 25).cast("string"))).alias("q_country"), pick(F.col("p_partkey"), "town", "").alias("q_city_key"), F.col("p_partkey").alias("q_ord"),
    )
    ranked = ranked.select("q_norm", fn.simple_name(F.col("q_norm")).alias("q_simple"), "q_country", fn.normalize_country(F.col("q_country")).alias("q_country_key"), "q_city_key", "q_ord")
    pairs = rankings.name_pairs(rankings.seed_names(seeds).select("university_id", *rankings.SEED_KIND), ranked.select("q_ord", *rankings.RANKED_KIND))
    return pairs.select("university_id", F.col("q_ord").alias("p_partkey"), "simple", "q_simple", "shared_letters", "shared_words")


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking records mined from pages, in the middle of which stands a JSON element that tells of the page's own host and path."""
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    host, path = fn.url_host(F.col("url")), fn.url_path(F.col("url"))
    rank, country = F.regexp_extract(path, "([0-9]+)", 1), F.regexp_extract(path, "^/([a-z]+)/", 1)
    record = F.concat(F.lit('{"props": [{"list": {"title": "<b>'), host, F.lit(' &amp; co</b>", "rank": "='), rank, F.lit('", "location": "'), country, F.lit('"}}, {"title": "no rank"}]}'))
    half = F.floor(F.length("html") / 2).cast("int")
    body = F.concat(F.substr("html", F.lit(1), half), F.lit('<script id="d" type="application/json">'), record, F.lit("</script>"), F.substr("html", half + 1))
    return rankings.records(p.select(body.alias("body"), n.alias(ORDER))).select("rank_raw", "institution_name", "country")


ALL = (
    classify_quality, stable_ids_and_hash, sentence_split_counts, html_links, html_strip_text, html_parse_text, url_resolve, link_classify_explode, link_dedupe_first, money_facts, usd_range, english_scores, cert_flags, deadline_candidates, program_rows, classify_evidence, facts_routing, match_report,
    tag_sets, facts_split_union, prefer_origin, first_value_by_order, ordered_distinct_summary, cert_join_display, coverage_score, batch_qa_counts, profile_flagship, field_gaps, quality_gate, import_qa_status, country_fallback, data_quality_fmt,
    normalize_source_map, drop_reason_counts, retry_filter, repairs_first_match, merge_crawl, merge_on_read, search_anti_join, promote_anti_union, rank_dedupe_argmin, name_normalize, token_similarity_join, candidate_confidence, json_cells, url_hosts,
    llm_quote_gate, model_facts, model_report, limit_offset_report, validation_errors, greedy_candidates, seq_ratio_match, name_pairs, json_records,
)

"""Pipeline tables made from the star-schema tables, so that the operators can be run and compared with SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provena.schemas import ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(key: Column, *values: str) -> Column:
    """One of the values by a key's remainder."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def money_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    low, high = F.floor("o_totalprice").cast("string"), F.floor(F.col("o_totalprice") * 1.1).cast("string")
    words, sign = pick(F.col("o_orderkey"), "tuition", "deposit", "housing", "living cost"), pick(F.col("o_custkey"), "USD", "£", "EUR", "S$", "¥")
    return o.select("o_orderkey", "o_custkey", F.concat(F.lit("The annual "), words, F.lit(" for this order is "), sign, F.lit(" "), low, F.lit(" to "), high, F.lit(".")).alias("body"))


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as facts of forty institutions."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    blank = {c: F.lit("") for c in ("program_id", "value_number", "value_currency", "value_date", "supporting_text", "review_status", "extracted_at")}
    made = blank | {
        "fact_id": F.concat(F.lit("f"), F.pmod(n, F.lit(7000)).cast("string")), "university_id": F.concat(F.lit("u"), F.pmod("user_id", F.lit(40)).cast("string")), "fact_type": pick(n, "application", "english_requirement", "cert_requirement"),
        "fact_key": F.when(F.pmod(n, F.lit(3)) == 0, pick(F.col("user_id"), "application_system", "portfolio_required")).when(F.pmod(n, F.lit(3)) == 1, pick(F.col("user_id"), "IELTS", "TOEFL", "PTE_subscore")).otherwise(pick(F.col("user_id"), "SAT", "A_LEVEL", "IB", "GRE", "TOPIK")),
        "value_text": F.when(F.pmod(n, F.lit(4)) == 0, "").otherwise(F.concat(F.lit("IELTS "), (F.lit(4) + F.pmod(n, F.lit(6))).cast("string"), F.lit(".5"))), "value_json": F.lit(""),
        "fact_origin": pick(n, "llm_extracted_from_source", "generated_by_rule", "manual", "extracted_from_source", "extracted_from_source", "inferred_from_text", "extracted_from_source"),
        "evidence_id": F.concat(F.lit("e"), F.pmod(n, F.lit(900)).cast("string")), "source_url": F.when(F.pmod(n, F.lit(11)) == 0, "").otherwise("https://example.org"), "confidence_score": F.lit("0.70"),
    }
    return e.select(*[c.alias(k) for k, c in made.items()], n.alias(ORDER))


def order_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sources of customers."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("source_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("university_id"), F.lit("").alias("university_name"), F.lit("").alias("country"),
        pick(F.col("o_orderkey"), "official_home", "undergraduate_admissions", "tuition_fees", "english_requirements", "housing", "career").alias("source_type"), F.concat(F.lit("https://example.org/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.substring("o_orderpriority", 1, 1).alias("priority"), F.lit("").alias("language_code"), F.lit("").alias("crawl_method"), F.when(F.col("o_orderstatus") == "F", "fetched").when(F.col("o_orderstatus") == "P", "manual").otherwise("failed").alias("status"),
        F.lit("").alias("last_crawled_at"), F.col("o_orderstatus").alias("notes"), F.col("o_orderkey").alias(ORDER),
    )


#: Source types of facts_routing, by nation.
ROUTED = ("scholarships", "program_catalog", "undergraduate_admissions", "housing", "tuition_fees", "career", "graduate_admissions")


def typed_sources(spark: SparkSession, sf_dir: str, ids: int, *types: str) -> DataFrame:
    """Nations as sources of a few ids, each id several times with changing types."""
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("k"), (k % ids).cast("string")).alias("source_id"), pick(k, *types).alias("source_type"), k.alias(ORDER))


def line_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as evidence of orders."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_id"), F.when(F.col("l_returnflag") == "R", "usable").when(F.col("l_returnflag") == "A", "blocked").otherwise("").alias("content_quality_status"))


def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a rough source map: alias ids, blank rows, bad urls and repeats among them."""
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    blank = F.pmod(n, F.lit(13)) == 0
    cell = lambda c: F.when(blank, " ").otherwise(c)
    url = F.when(F.pmod(n, F.lit(7)) == 0, F.concat(F.lit("www"), F.col("url"))).when(F.pmod(n, F.lit(5)) == 0, "https://example.org/same").otherwise(F.col("url"))
    return p.select(
        F.when(F.pmod(n, F.lit(3)) == 0, cell(F.concat(F.lit("src_"), n.cast("string")))).otherwise("").alias("source_id"), cell(pick(n, "mit_us", "cam_uk", "ALGERIA", "BRAZIL", "zz")).alias("university_id"), cell(F.lit("named")).alias("university_name"),
        cell(F.lit("")).alias("country"), cell(pick(n, "official_home", "tuition_fees", "blog")).alias("source_type"), cell(url).alias("url"), cell(pick(n, "", "1", "x", "0")).alias("priority"), F.lit("").alias("language_code"),
        cell(pick(n, "", "pdf", "robot")).alias("crawl_method"), F.lit("").alias("status"), F.lit("").alias("last_crawled_at"), F.lit("").alias("notes"), n.alias(ORDER),
    )


def nation_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_name").alias("university_id"), F.initcap("n_name").alias("name"), F.col("r_name").alias("country"), F.concat(F.lit("https://www."), F.lower(F.replace("n_name", F.lit(" "), F.lit(""))), F.lit(".example.edu")).alias("website_url"), F.col("n_nationkey").cast("long").alias(ORDER))


def supplier_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("s"), key.cast("string")).alias("university_id"), F.col("s_name").alias("name"), F.lit("").alias("local_name"), F.col("n_name").alias("country"), F.when(F.pmod(key, F.lit(9)) == 0, "").otherwise("Town").alias("city"),
        F.lit("").alias("region"), F.lit("").alias("country_group"), F.lit("https://example.org").alias("website_url"), F.lit("public").alias("type"),
    )


def supplier_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as facts of suppliers, by line number."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    k, n = F.col("l_linenumber"), F.col("l_orderkey")
    low = F.floor("l_extendedprice").cast("string")
    code = pick(n, "USD", "GBP", "SGD", "XXX")
    money = F.concat(F.lit('{"min": '), low, F.lit(', "max": '), F.floor(F.col("l_extendedprice") * 1.2).cast("string"), F.lit(', "currency": "'), code, F.lit('"}'))
    dated = F.concat(F.lit('{"date_text": "'), F.date_format("l_shipdate", "d MMM yyyy"), F.lit('", "round_name": "'), pick(n, "early", "regular", ""), F.lit('"}'))
    kinds = F.when(k == 1, "tuition").when(k.isin(2, 3), "matching").when(k.isin(4, 7), "application").when(k == 5, "english_requirement").otherwise("scholarship")
    keys = F.when(k == 1, "tuition_fee").when(k == 2, "subject_tag").when(k == 3, "study_level_tag").when(k == 4, "application_system").when(k == 5, "IELTS").when(k == 7, "application_deadline_candidate").otherwise("scholarship_available")
    values = F.when(k == 2, pick(n, "law", "business", "medicine", "education", "engineering", "hospitality", "humanities")).when(k == 3, pick(n, "master", "bachelor")).when(k == 4, pick(n, "ucas", "direct", "ouac")).when(k == 5, F.concat(F.lit("IELTS "), (F.lit(4) + F.pmod(n, F.lit(5))).cast("string"), F.lit(".0"))).when(k == 6, pick(n, "true", "false")).otherwise("")
    return l.select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("university_id"), kinds.alias("fact_type"), keys.alias("fact_key"), values.alias("value_text"), F.when(k == 1, money).when(k == 7, dated).otherwise("").alias("value_json"),
        F.when(F.pmod(n, F.lit(50)) == 0, "llm_extracted_from_source").otherwise("extracted_from_source").alias("fact_origin"), F.concat(F.lit("e"), n.cast("string")).alias("evidence_id"), F.lit("https://example.org").alias("source_url"), (n * 10 + k).alias(ORDER),
    )


def supplier_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as sources of suppliers."""
    p, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    count = table(spark, sf_dir, "supplier").agg(F.count("*").alias("n_suppliers"))
    return p.crossJoin(F.broadcast(count)).select(  # one row
        F.concat(F.lit("p"), n.cast("string")).alias("source_id"), F.concat(F.lit("s"), (F.pmod(n, F.col("n_suppliers")) + 1).cast("string")).alias("university_id"),
        pick(F.col("p_size"), "official_home", "undergraduate_admissions", "tuition_fees", "english_requirements", "housing").alias("source_type"), F.when(F.col("p_size") % 3 == 0, "failed").otherwise("fetched").alias("status"),
    )


def part_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.concat(F.lit("p"), n.cast("string")).alias("source_id"), F.when(F.pmod(n, F.lit(4)) == 0, "blocked").otherwise("usable").alias("content_quality_status"))


def nation_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), F.when(n % 5 == 0, "").otherwise((F.lit(9000) + n * 100).cast("string")).alias("annual_living_usd_min"), (F.lit(15000) + n * 100).cast("string").alias("annual_living_usd_max"), n.cast("long").alias(ORDER))

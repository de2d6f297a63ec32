"""Profiles: facts, sources, rankings and country costs rolled up to one typed row for each institution, with QA.

Facts are summarised in two steps, (institution, type, key, from a model or not) and then
institution, both as hash aggregates with map-side combine: no window over an institution's facts,
so one institution may hold any share of them. Model facts replace others where a field prefers
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provena import functions as fn
from provena import lexicons as lx
from provena.schemas import BATCH_QA, GAP, GATE, MATCHING, ORDER, PRODUCT, QA, WRITER, last_wins, ordered, text

AVOID = (
    "Do not claim exact rankings, outcomes, or program details unless the fact is reviewed.",
    "Use the evidence-backed profile fields as context, not as final verified copy.",
)
BAD_QUALITY = ("blocked", "js_challenge", "too_short", "not_found", "low_signal")


def parsed(*fields: str) -> Column:
    """Fields of value_json as a struct of texts; null for a blank one."""
    return F.when(text("value_json") != "", F.from_json("value_json", ", ".join(f"`{f}` string" for f in fields)))


def fact_groups(facts: DataFrame) -> DataFrame:
    """Facts summarised by institution, type, key and origin class."""
    value, code = text("value_text"), F.coalesce("_v.currency", F.lit("USD"))
    # steps of their own, so that the JSON is parsed and an amount converted once for each row
    rows = ordered(facts).withColumn("_v", parsed("min", "max", "currency"))
    rows = rows.withColumns({f"_{k}": fn.usd(F.col(f"_v.{k}").try_cast("double"), code) for k in ("min", "max")})
    low, high = F.col("_min"), F.col("_max")
    both = low.isNotNull() & high.isNotNull()
    return rows.groupBy(text("university_id").alias("university_id"), text("fact_type").alias("fact_type"), text("fact_key").alias("fact_key"), (text("fact_origin") == lx.LLM_ORIGIN).alias("model")).agg(
        F.count("*").alias("n"), F.min_by(F.when(value != "", F.col("value_text")), F.when(value != "", F.col(ORDER))).alias("first"),
        F.min(F.when(both, low)).alias("low"), F.max(F.when(both, high)).alias("high"),
    )


def preferred_values(facts: DataFrame) -> DataFrame:
    """(university_id, fact_type, fact_key, value, usd_min, usd_max): from a key's model facts where it has any, else from the others."""
    pick = lambda c: F.max_by(F.struct(F.col(c).alias("v")), "model")["v"]
    return fact_groups(facts).groupBy("university_id", "fact_type", "fact_key").agg(pick("first").alias("value"), pick("low").alias("usd_min"), pick("high").alias("usd_max"))


def summaries(facts: DataFrame, value: Column, limit: int) -> DataFrame:
    """(university_id, model, found): distinct values in the order in which they first appear (ties: by value), at most `limit`.

    The window keeps `limit` values of each map task before its shuffle, so no institution's values meet in one task.
    """
    rows = ordered(facts)
    # the generator keeps the filter from computing the value a second time
    rows = rows.select(text("university_id").alias("university_id"), (text("fact_origin") == lx.LLM_ORIGIN).alias("model"), F.explode(F.array(value)).alias("value"), ORDER).filter("value <> ''")
    firsts = rows.groupBy("university_id", "model", "value").agg(F.min(ORDER).alias("at"))
    place = F.row_number().over(Window.partitionBy("university_id", "model").orderBy("at", "value"))
    kept = firsts.withColumn("place", place).filter(F.col("place") <= limit)
    return kept.groupBy("university_id", "model").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("found"))


def deadline_values(facts: DataFrame) -> DataFrame:
    """Deadline facts with `_deadline`: round and date as a summary shows them; blank without a date."""
    rows = facts.filter((text("fact_type") == "application") & (text("fact_key") == "application_deadline_candidate")).withColumn("_v", parsed("date_text", "round_name"))
    date, name = F.col("_date"), F.col("_round")
    rows = rows.withColumns({"_date": fn.clean_summary(text("_v.date_text"), 40), "_round": fn.clean_summary(text("_v.round_name"), 40)})
    # capital after anything that isn't a letter
    title = F.initcap(F.regexp_replace(name, r"([^\p{L} ])", "$1 "))
    title = F.regexp_replace(title, r"([^\p{L} ]) ", "$1")
    return rows.withColumn("_deadline", F.when(date.rlike(f"(?i){lx.DATE}"), F.concat(F.when(name == "", "Deadline").otherwise(title), F.lit(": "), date)).otherwise(""))


def fact_fields(facts: DataFrame) -> DataFrame:
    """One row for each institution with facts: fields and counts from its facts."""
    groups = fact_groups(facts)
    is_key = lambda t, k: (F.col("fact_type") == t) & (F.col("fact_key") == k)

    def pick(t: str, k: str, field: str) -> Column:
        """The field of a key's model facts if it has any, else of the others."""
        return F.max_by(F.when(is_key(t, k), F.struct(F.col(field).alias("v"))), F.when(is_key(t, k), F.col("model")))["v"]

    count = lambda t, k=None: F.coalesce(F.sum(F.when((F.col("fact_type") == t) & (F.lit(True) if k is None else F.col("fact_key") == k), F.col("n"))), F.lit(0))
    fields = groups.groupBy("university_id").agg(
        pick("tuition", "tuition_fee", "low").alias("tuition_min"), pick("tuition", "tuition_fee", "high").alias("tuition_max"),
        pick("living_cost", "living_cost", "low").alias("living_min"), pick("living_cost", "living_cost", "high").alias("living_max"),
        pick("scholarship", "scholarship_available", "first").alias("scholarship"), pick("application", "application_system", "first").alias("application_system"),
        pick("application", "portfolio_required", "first").alias("portfolio"), pick("application", "interview_required", "first").alias("interview"),
        F.array_sort(F.collect_set(F.when((F.col("fact_type") == "cert_requirement") & (F.col("fact_key") != ""), F.col("fact_key")))).alias("cert_requirement_tags"),
        F.sum("n").alias("fact_count"), count("tuition").alias("tuition_fact_count"), count("tuition", "tuition_fee").alias("valid_tuition_fact_count"),
        count("application").alias("deadline_fact_count"), count("application", "application_deadline_candidate").alias("valid_deadline_fact_count"), count("english_requirement").alias("english_fact_count"),
        F.coalesce(F.sum(F.when((F.col("fact_type") == "english_requirement") & ~F.col("fact_key").endswith("_subscore"), F.col("n"))), F.lit(0)).alias("valid_english_fact_count"), count("matching").alias("matching_tag_count"),
        F.coalesce(F.bool_or(F.when(F.col("fact_type") == "english_requirement", F.col("model"))), F.lit(False)).alias("model_english"),
        # a model's key with no usable value still replaces the others
        F.bool_or(F.when(is_key("application", "application_deadline_candidate"), F.col("model"))).alias("model_deadline"),
    )
    tagged = facts.filter((text("fact_type") == "matching") & (text("value_text") != "")).groupBy(text("university_id").alias("university_id")).agg(
        *[F.array_sort(F.collect_set(F.when(F.col("fact_key") == key, F.col("value_text")))).alias(name) for name, key in (("subject_all", "subject_tag"), ("study_level_tags", "study_level_tag"), ("campus_vibe_tags", "campus_vibe_tag"), ("support_tags", "support_tag"))]
    )
    english = summaries(facts.filter((text("fact_type") == "english_requirement") & text("fact_key").isin("IELTS", "TOEFL", "PTE", "Duolingo")), fn.clean_summary(text("value_text"), 80), 3)
    english = english.groupBy("university_id").agg(F.max(F.when(F.col("model"), F.col("found"))).alias("english_model"), F.max(F.when(~F.col("model"), F.col("found"))).alias("english_other"))
    cited = facts.filter(text("evidence_id") != "").groupBy(text("university_id").alias("university_id")).agg(F.count_distinct("evidence_id").alias("evidence_count"))
    by_deadline = summaries(deadline_values(ordered(facts)), F.col("_deadline"), 3)
    by_deadline = by_deadline.groupBy("university_id").agg(F.max(F.when(F.col("model"), F.col("found"))).alias("deadline_model"), F.max(F.when(~F.col("model"), F.col("found"))).alias("deadline_other"))
    out = fields
    for more in (tagged, english, by_deadline, cited):
        out = out.join(more, "university_id", "left")
    none = F.array().cast("array<string>")
    one_of = lambda kind, sep: F.array_join(F.coalesce(F.when(F.col(f"model_{kind}"), F.col(f"{kind}_model")).otherwise(F.col(f"{kind}_other")), none), sep)
    out = out.withColumns({"_deadlines": one_of("deadline", "; "), "_english": one_of("english", " or ")})
    return out.select(
        "university_id", "tuition_min", "tuition_max", "living_min", "living_max", "scholarship", "application_system", "portfolio", "interview", "cert_requirement_tags", "fact_count", "tuition_fact_count", "valid_tuition_fact_count",
        "deadline_fact_count", "valid_deadline_fact_count", "english_fact_count", "valid_english_fact_count", "matching_tag_count",
        F.slice(F.coalesce("subject_all", none), 1, 5).alias("subject_tags"), *[F.coalesce(c, none).alias(c) for c in ("study_level_tags", "campus_vibe_tags", "support_tags")],
        fn.clean_summary(F.col("_deadlines"), 180).alias("deadlines"),
        fn.clean_summary(F.col("_english"), 160).alias("english"), F.coalesce("evidence_count", F.lit(0)).alias("evidence_count"),
    )


def source_fields(sources: DataFrame, evidence: DataFrame | None) -> DataFrame:
    """One row for each institution with sources: counts, and the share of required types with usable evidence."""
    rows = sources.select(text("university_id").alias("university_id"), text("source_id").alias("source_id"), text("source_type").alias("source_type"), text("status").alias("status"))
    if evidence is None:
        per_source = rows.withColumns({"usable": F.lit(0).cast("long"), "bad": F.lit(0).cast("long")})
    else:
        kind = text("content_quality_status")
        counts = evidence.groupBy(text("source_id").alias("source_id")).agg(F.count_if(kind.isin("", "usable")).alias("usable"), F.count_if(kind.isin(*BAD_QUALITY)).alias("bad"))
        per_source = rows.join(counts, "source_id", "left")
    covered = F.col("status").isin("fetched", "manual") & (F.coalesce("usable", F.lit(0)) > 0) & F.col("source_type").isin(*lx.REQUIRED_SOURCE_TYPES)
    return per_source.groupBy("university_id").agg(
        F.count("*").alias("source_count"), F.count_if(F.col("status") == "failed").alias("failed_source_count"), F.coalesce(F.sum("usable"), F.lit(0)).alias("usable_evidence_count"), F.coalesce(F.sum("bad"), F.lit(0)).alias("blocked_evidence_count"),
        (F.size(F.collect_set(F.when(covered, F.col("source_type")))) / F.lit(float(len(lx.REQUIRED_SOURCE_TYPES)))).alias("coverage"),
    )


def joined_text(*values: Column) -> Column:
    """Distinct values that aren't blank, joined by a semicolon."""
    return F.array_join(F.array_distinct(F.filter(F.array(*values), lambda v: v != "")), "; ")


def certificate_summary(tags: Column) -> Column:
    names = F.transform(tags, lambda t: F.coalesce(fn.lookup(lx.CERTIFICATE_NAMES, t), F.replace(t, F.lit("_"), F.lit("-"))))
    return fn.clean_summary(F.array_join(F.slice(names, 1, 8), "; "), 160)


def validated(df: DataFrame) -> DataFrame:
    """Implausible costs blanked, summaries checked again, totals and the requirement summary made."""
    odd = (F.coalesce(F.col("tuition_usd_min") < 500, F.lit(False))) | F.coalesce(F.col("tuition_usd_max") > 120000, F.lit(False))
    dear = F.coalesce(F.col("living_cost_usd_min") > 60000, F.lit(False))
    gone = lambda c, when: F.when(~when, F.col(c))
    out = df.withColumns({"tuition_usd_min": gone("tuition_usd_min", odd), "tuition_usd_max": gone("tuition_usd_max", odd), "living_cost_usd_min": gone("living_cost_usd_min", dear), "living_cost_usd_max": gone("living_cost_usd_max", dear)})
    deadline, english = fn.clean_summary(F.col("deadline_summary"), 180), fn.clean_summary(F.col("english_requirement_summary"), 160)
    out = out.withColumns({"deadline_summary": F.when(deadline.rlike(f"(?i){lx.DATE}"), deadline).otherwise(""), "english_requirement_summary": F.when(english.rlike(f"(?i){lx.VALID_ENGLISH}"), english).otherwise("")})
    flags = [F.when(F.coalesce(F.col(c), F.lit(False)), label).otherwise("") for c, label in (("portfolio_required", "Portfolio required"), ("interview_required", "Interview required"))]
    return out.withColumns({
        "requirement_summary": fn.clean_summary(joined_text(F.col("deadline_summary"), F.col("english_requirement_summary"), F.col("cert_requirement_summary"), *flags), 280),
        "total_cost_usd_min": F.col("tuition_usd_min") + F.col("living_cost_usd_min"), "total_cost_usd_max": F.col("tuition_usd_max") + F.col("living_cost_usd_max"),
    })


def missing_fields(df: DataFrame) -> Column:
    """The must-have fields that a profile lacks: blank texts, nulls and empty lists; false and 0 count as present."""
    kinds = dict(df.dtypes)

    def lacks(name: str) -> Column:
        if kinds[name].startswith("array"):
            return F.size(name) == 0
        return text(name) == "" if kinds[name] == "string" else F.col(name).isNull()

    return F.filter(F.array(*[F.when(lacks(n), F.lit(n)) for n in lx.SCORED_FIELDS]), lambda n: n.isNotNull())


def import_status() -> Column:
    identity = F.lit(True)
    for c in ("display_name", "country", "city", "website_url", "type"):
        identity = identity & (text(c) != "")
    matching = (F.size("subject_tags") > 0) & (F.size("study_level_tags") > 0)
    budget = (F.coalesce("living_cost_usd_min", F.lit(0)) != 0) & (F.coalesce("living_cost_usd_max", F.lit(0)) != 0)
    return F.when(F.size("missing") == 0, "ready_for_import").when(identity & matching & budget, "internal_preview").when(identity, "identity_only").otherwise("do_not_import")


def qa_status() -> tuple[Column, Column]:
    ready, preview = F.col("import_status") == "ready_for_import", F.col("import_status") == "internal_preview"
    failed = F.col("failed_source_count") >= 4
    thin = (F.col("valid_tuition_fact_count") == 0) | (F.col("valid_deadline_fact_count") == 0) | (F.col("valid_english_fact_count") == 0)
    status = F.when(ready | preview, "ready_for_internal_preview").when(failed, "needs_source_repair").when(thin, "needs_fact_repair").otherwise("ready_for_internal_preview")
    notes = F.when(ready, "validated profile fields present").when(preview, "usable for internal product review").when(failed, "multiple failed sources").when(thin, "missing validated tuition/deadline/English facts").otherwise("minimum validated facts present")
    return status, notes


def writer_context() -> Column:
    part = lambda c: F.slice(c, 1, 5)
    return F.struct(
        F.array(*map(F.lit, AVOID)).alias("avoid_generic_claims"), part("campus_vibe_tags").alias("campus_vibe_tags"), F.concat(F.lit("Generated from pilot ingestion facts for "), text("display_name"), F.lit(".")).alias("source_note"),
        F.lit("generated_needs_review").alias("status"), part("best_for").alias("student_fit_keywords"), part("support_tags").alias("support_tags"), part("strengths").alias("why_this_university_points"),
    )


def build(seed: DataFrame, sources: DataFrame, facts: DataFrame, rankings: DataFrame, costs: DataFrame | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """One typed row for each seed row: the columns of PRODUCT and, beside them, what the QA outputs need."""
    seeds = seed.select(*[text(c).alias(c) if c in seed.columns else F.lit("").alias(c) for c in ("university_id", "name", "local_name", "country", "city", "region", "country_group", "website_url", "type")])
    ranks = last_wins(ordered(rankings.select("university_id", *[text(c).alias(c) if c in rankings.columns else F.lit("").alias(c) for c in ("qs_rank", "the_rank", "arwu_rank", "rank_display")])), "university_id").drop(ORDER)
    rows = seeds.join(fact_fields(facts), "university_id", "left").join(source_fields(sources, evidence), "university_id", "left").join(ranks, "university_id", "left")
    if costs is None:
        rows = rows.withColumns({"cost_min": F.lit(None).cast("long"), "cost_max": F.lit(None).cast("long")})
    else:
        low, high = fn.as_int(text("annual_living_usd_min")), fn.as_int(text("annual_living_usd_max"))
        whole = low.isNotNull() & high.isNotNull()
        priced = last_wins(ordered(costs), "country").select("country", F.when(whole, low).alias("cost_min"), F.when(whole, high).alias("cost_max"))
        rows = rows.join(priced, "country", "left")
    none = F.array().cast("array<string>")
    unsure = F.col("living_min").isNull() | F.col("living_max").isNull() | (F.col("living_min") > 60000) | (F.col("living_max") > 60000)
    lists = {c: F.coalesce(c, none) for c in ("subject_tags", "study_level_tags", "campus_vibe_tags", "support_tags", "cert_requirement_tags")}
    counts = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("source_count", "failed_source_count", "usable_evidence_count", "blocked_evidence_count", "evidence_count", "fact_count", "tuition_fact_count", "valid_tuition_fact_count", "deadline_fact_count", "valid_deadline_fact_count", "english_fact_count", "valid_english_fact_count", "matching_tag_count")}
    rows = rows.withColumns(lists | counts | {c: text(c) for c in ("qs_rank", "the_rank", "arwu_rank", "rank_display", "application_system")})
    has = lambda c, tag: F.array_contains(c, tag)
    optional = lambda when, tag: F.when(when, F.array(F.lit(tag))).otherwise(none)
    rows = rows.withColumns({
        "display_name": F.col("name"), "image_url": F.lit(""), "short_description": F.lit(""), "weaknesses": none, "review_status": F.lit("needs_review"),
        "tuition_usd_min": F.col("tuition_min"), "tuition_usd_max": F.col("tuition_max"),
        "living_cost_usd_min": F.when(unsure, F.col("cost_min")).otherwise(F.col("living_min")), "living_cost_usd_max": F.when(unsure, F.col("cost_max")).otherwise(F.col("living_max")),
        "scholarship_available": fn.truth(text("scholarship")), "portfolio_required": fn.truth(text("portfolio")), "interview_required": fn.truth(text("interview")),
        "deadline_summary": text("deadlines"), "english_requirement_summary": text("english"), "cert_requirement_summary": certificate_summary(F.col("cert_requirement_tags")),
        "strengths": F.array_sort(F.array_distinct(F.concat(F.slice("subject_tags", 1, 5), optional(has("support_tags", "career_services"), "career_support"), optional(has("support_tags", "scholarship"), "scholarship_options")))),
        "best_for": F.array_sort(F.concat(F.transform(F.slice("subject_tags", 1, 1), lambda t: F.concat(F.lit("students_interested_in_"), t)), optional(has("study_level_tags", "master"), "graduate_applicants"), optional(has("support_tags", "strong_international_office"), "international_students"))),
        "evidence_coverage_score": fn.two_decimals(F.coalesce("coverage", F.lit(0.0))),
    })
    rows = validated(rows.withColumn("writer_context", writer_context()))
    rows = rows.withColumn("missing", missing_fields(rows))
    rows = rows.withColumn("data_quality_score", fn.two_decimals((F.lit(len(lx.SCORED_FIELDS)) - F.size("missing")) / F.lit(float(len(lx.SCORED_FIELDS)))))
    rows = rows.withColumn("import_status", import_status())
    rows = rows.withColumn("review_status", F.when(F.col("import_status") != "ready_for_import", "draft").otherwise("needs_review"))
    status, notes = qa_status()
    rows = rows.withColumns({"qa_status": status, "qa_notes": notes})
    return rows.select(*PRODUCT, "name", "missing", *counts, "qa_status", "qa_notes")


def products(built: DataFrame) -> DataFrame:
    return built.select(*PRODUCT)


def matching_tags(built: DataFrame) -> DataFrame:
    return built.select(*MATCHING)


def writer_contexts(built: DataFrame) -> DataFrame:
    return built.select(*WRITER)


def qa_report(built: DataFrame) -> DataFrame:
    return built.withColumns({"required_source_coverage": F.col("evidence_coverage_score"), "missing_must_have_fields": F.col("missing")}).select(*QA)


def batch_qa(built: DataFrame) -> DataFrame:
    return built.withColumn("has_product_profile", F.lit(True)).select(*BATCH_QA)


def field_gaps(built: DataFrame) -> DataFrame:
    return built.withColumn("missing_field", F.explode("missing")).select(*GAP)


def gate_row(metric: str, value: Column, threshold: float, notes: str) -> Column:
    rounded = F.bround(value, 2)
    return F.struct(F.lit(metric).alias("metric"), F.format_string("%.2f", rounded).alias("value"), F.lit(f"{threshold:.2f}").alias("threshold"), F.when(rounded >= threshold, "pass").otherwise("fail").alias("status"), F.lit(notes).alias("notes"))


def quality_gate(built: DataFrame, facts: DataFrame) -> DataFrame:
    """Four global rates against their thresholds; the average is over the scores as exported (two decimals)."""
    share = lambda c: F.coalesce(F.try_divide(F.count_if(c), F.count("*")), F.lit(0.0))
    of_profiles = built.agg(
        share(F.col("evidence_coverage_score").cast("double") >= 1.0).alias("complete"), F.coalesce(F.avg(F.col("data_quality_score").cast("double")), F.lit(0.0)).alias("quality"),
        share((F.size("subject_tags") > 0) & (F.size("study_level_tags") > 0)).alias("ready"),
    )
    of_facts = facts.agg(F.coalesce(F.try_divide(F.count_if((text("evidence_id") != "") & (text("source_url") != "")), F.count("*")), F.lit(1.0)).alias("linked"))
    rows = of_profiles.crossJoin(of_facts)  # one row each
    gates = F.array(
        gate_row("universities_with_required_sources", F.col("complete"), 0.90, "Share of universities with official_home, admissions, tuition_fees, and english_requirements sources fetched/manual."),
        gate_row("facts_with_evidence_links", F.col("linked"), 1.00, "Every emitted fact must have evidence_id and source_url."),
        gate_row("average_data_quality_score", F.col("quality"), 0.70, "Average completeness across pilot must-have fields."),
        gate_row("matching_readiness_rate", F.col("ready"), 0.80, "Share of profiles with both subject_tags and study_level_tags."),
    )
    return rows.select(F.inline(gates)).select(*GATE)


def match_score(profiles: DataFrame, wish: DataFrame) -> DataFrame:
    """Published weights of a student's wish against a profile: country, subject, budget, level, vibe, support; 0 to 100."""
    w = lx.MATCH_WEIGHTS
    share = lambda mine, theirs, points: F.when(F.size(mine) > 0, F.size(F.array_intersect(mine, theirs)) / F.size(mine) * points).otherwise(F.lit(0.0))
    both = wish.join(profiles, F.array_contains("countries", F.col("country")))
    score = (
        F.lit(float(w["country"])) + share(F.col("subjects"), F.col("subject_tags"), w["subject"]) + F.when(F.col("total_cost_usd_min") <= F.col("budget_usd"), float(w["budget"])).otherwise(0.0)
        + share(F.col("levels"), F.col("study_level_tags"), w["level"]) + share(F.col("vibes"), F.col("campus_vibe_tags"), w["vibe"]) + share(F.col("supports"), F.col("support_tags"), w["support"])
    )
    return both.select("student_id", "university_id", F.bround(score, 0).cast("int").alias("match_score"))

"""Fact extraction from usable evidence, in native expressions.

Every extractor is a Column: an array of fact structs for one text. A row's arrays are joined into
one and exploded, so extraction is a narrow projection after the join with the sources.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena import functions as fn
from provena import lexicons as lx
from provena.operators.quality import usable
from provena.schemas import FACT, ORDER, PROGRAM, last_wins, order_key, ordered, text

PARTS = "array<struct<fact_type:string,fact_key:string,value_text:string,value_json:string,value_number:string,value_currency:string,value_date:string,fact_origin:string,supporting_text:string,confidence_score:string,review_status:string>>"


def fact(fact_type: Column | str, fact_key: Column | str, value_text: Column | str = "", value_json: Column | str = "", value_number: Column | str = "", value_currency: Column | str = "", confidence: Column | float = 0.7, origin: str = "extracted_from_source", review: str = "needs_review", value_date: Column | str = "", supporting: Column | str = "") -> Column:
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    score = confidence if isinstance(confidence, Column) else F.lit(f"{confidence:.2f}")
    return F.struct(
        col(fact_type).alias("fact_type"), col(fact_key).alias("fact_key"), col(value_text).alias("value_text"), col(value_json).alias("value_json"), col(value_number).alias("value_number"),
        col(value_currency).alias("value_currency"), col(value_date).alias("value_date"), F.lit(origin).alias("fact_origin"), col(supporting).alias("supporting_text"), score.alias("confidence_score"), F.lit(review).alias("review_status"),
    )


def present(*facts: Column) -> Column:
    """The facts that aren't null, in their order."""
    return F.filter(F.array(*facts), lambda f: f.isNotNull())


def tag_facts(lowered: Column, fact_type: str, key: str, lexicon: Mapping[str, Sequence[str]], confidence: float, origin: str = "extracted_from_source", review: str = "needs_review") -> Column:
    return F.transform(fn.tags(lowered, lexicon), lambda t: fact(fact_type, key, t, confidence=confidence, origin=origin, review=review))


def keyword_fact(lowered: Column, fact_type: str, key: str, words: Sequence[str]) -> Column:
    """One fact with the first of the words that the text has, or none."""
    found = F.coalesce(*[F.when(lowered.contains(w), F.lit(w)) for w in words])
    return present(F.when(found.isNotNull(), fact(fact_type, key, found, confidence=0.62)))


def common_tags(lowered: Column, source_type: Column) -> Column:
    catalogue = source_type.isin("program_catalog", *lx.ADMISSIONS)
    subject = F.concat(tag_facts(lowered, "matching", "subject_tag", lx.SUBJECTS, 0.62, "inferred_from_text"), tag_facts(lowered, "matching", "study_level_tag", lx.STUDY_LEVELS, 0.62, "inferred_from_text"))
    return F.concat(
        F.when(catalogue, subject).otherwise(F.array().cast(PARTS)),
        tag_facts(lowered, "matching", "campus_vibe_tag", lx.VIBES, 0.45, "generated_by_rule", "generated"),
        tag_facts(lowered, "matching", "support_tag", lx.SUPPORTS, 0.6, "inferred_from_text"),
    )


MONEY_CORE = rf"(<{lx.CURRENCY_SIGNS})\s?(<{lx.AMOUNT})(?:\s?(?:-|to|–|—)\s?(<{lx.CURRENCY_SIGNS})?\s?(<{lx.AMOUNT}))?"


#: Two noncharacters, which no text holds in interchange; they mark matches and become U+FFFD where a text has them.
MARKS = ("\ufdd0", "\ufdd1")


def marked_matches(body: Column, pattern: str, radius: int, limit: int) -> Column:
    """The first matches of a pattern: struct (raw, context), the context with `radius` characters on both sides.

    One pass of the pattern puts marks around the matches; places then follow from the lengths between them.
    """
    whole = F.translate(body, "".join(MARKS), "\ufffd\ufffd")
    parts = F.split(F.regexp_replace(whole, F.lit(pattern), F.lit(f"{MARKS[0]}$0{MARKS[1]}")), MARKS[0])
    first = F.struct(F.length(F.get(parts, F.lit(0))).alias("at"), F.array().cast("array<struct<at:int,raw:string>>").alias("found"))

    def add(held: Column, part: Column) -> Column:
        match = F.struct(held["at"].alias("at"), F.substring_index(part, MARKS[1], 1).alias("raw"))
        return F.struct((held["at"] + F.length(part) - 1).alias("at"), F.array_append(held["found"], match).alias("found"))

    found = F.aggregate(F.slice(parts, 2, limit), first, add, lambda held: held["found"])

    def shaped(m: Column) -> Column:
        before = F.least(m["at"], F.lit(radius))
        return F.struct(m["raw"].alias("raw"), F.substr(whole, m["at"] - before + 1, before + F.length(m["raw"]) + radius).alias("context"))

    return F.transform(found, shaped)


def money_matches(body: Column, limit: int = 40) -> Column:
    """The first matches of an amount with a currency: struct (raw, currency, low, high, context)."""
    grouped = f"(?is)^{MONEY_CORE.replace('(<', '(')}"

    # step by step: what a step makes is read by the next ones, not worked out again
    def read(m: Column) -> Column:
        part = lambda k: F.regexp_extract(m["raw"], grouped, k)
        number = lambda x: F.nullif(F.regexp_replace(x, r"[^0-9]", "").try_cast("long"), F.lit(0))
        return F.struct(m["raw"].alias("raw"), m["context"].alias("context"), F.upper(part(1)).alias("sign"), number(part(2)).alias("one"), number(part(4)).alias("two"))

    def shaped(m: Column) -> Column:
        # least and greatest skip nulls
        code = F.coalesce(fn.lookup(lx.CURRENCY_CODES, m["sign"]), m["sign"])
        return F.struct(m["raw"].alias("raw"), code.alias("currency"), F.least(m["one"], m["two"]).alias("low"), F.greatest(m["one"], m["two"]).alias("high"), fn.clean_sentence(m["context"]).alias("context"))

    plain = f"(?is){MONEY_CORE.replace('(<', '(?:')}"
    found = F.filter(F.transform(marked_matches(body, plain, 140, limit), read), lambda m: m["one"].isNotNull() | m["two"].isNotNull())
    return F.transform(found, shaped)


def money_label(low: Column) -> Column:
    """What an amount is for, from the lower-cased words around it, or `reject`."""
    label = lambda skip: F.coalesce(*[F.when(fn.contains_any(low, words), F.lit(name)) for name, words in lx.MONEY_LABELS.items() if name != skip], F.lit("reject"))
    return F.when(fn.contains_any(low, lx.MONEY_REJECT), label("tuition_fee")).otherwise(label(""))


def money_facts(body: Column, forced: str | None = None) -> Column:
    """Facts of the amounts in a text: read, lower-cased, labelled, and only then, if the label isn't `reject`, made."""
    columns = ("raw", "currency", "low", "high", "context")
    held = lambda m: [m[c].alias(c) for c in columns]
    found = money_matches(body)
    if forced:
        labelled = F.transform(found, lambda m: F.struct(*held(m), F.lit(forced).alias("label")))
    else:
        lowered = F.transform(found, lambda m: F.struct(*held(m), F.lower(m["context"]).alias("words")))
        labelled = F.filter(F.transform(lowered, lambda m: F.struct(*held(m), money_label(m["words"]).alias("label"))), lambda m: m["label"] != "reject")

    def made(m: Column) -> Column:
        label = m["label"]
        payload = fn.json_object(min=m["low"].cast("string"), max=m["high"].cast("string"), currency=fn.json_text(m["currency"]), classification=fn.json_text(label), context=fn.json_text(F.substring(m["context"], 1, 240)))
        kind = F.when(label == "tuition_fee", "tuition").otherwise(label)
        return fact(kind, label, m["raw"], payload, m["low"].cast("string"), m["currency"], F.when(label == "tuition_fee", "0.74").otherwise("0.55"))

    return F.transform(labelled, made)


def english_verdict(test: str, score: Column) -> Column:
    if test == "IELTS":
        return F.when(score.between(4.0, 9.0), "overall").otherwise("reject")
    if test == "TOEFL":
        return F.when(score.between(40, 120), "overall").when(score.between(0, 30), "subscore").otherwise("reject")
    return F.when(score.between(30, 90), "overall").otherwise("reject")


def english_summary(body: Column) -> Column:
    """The first two sentences of 30 characters or more that name a test or the language."""
    cleaned = F.transform(fn.sentences(body), fn.clean_sentence)
    named = F.filter(cleaned, lambda s: (F.length(s) >= 30) & fn.contains_any(F.lower(s), lx.ENGLISH_WORDS))
    return F.rtrim(F.substring(F.array_join(F.slice(named, 1, 2), " "), 1, 500))


def english_facts(body: Column) -> Column:
    out = []
    for test, pattern in (("IELTS", lx.IELTS), ("TOEFL", lx.TOEFL), ("PTE", lx.PTE)):
        written = F.regexp_extract(body, f"(?i){pattern}", 1)
        score = written.try_cast("double")
        verdict = english_verdict(test, score)
        shown = score.cast("string")
        payload = fn.json_object(test=F.lit(f'"{test}"'), overall=F.when(verdict == "overall", shown).otherwise("null"), subscore_min=F.when(verdict == "subscore", shown).otherwise("null"))
        key = F.when(verdict == "overall", test).otherwise(f"{test}_subscore")
        out.append(F.when(score.isNotNull() & (verdict != "reject"), fact("english_requirement", key, F.concat(F.lit(f"{test} "), written), payload, shown, confidence=F.when(verdict == "overall", "0.72").otherwise("0.48"))))
    summary = english_summary(body)
    return present(*out, F.when(summary != "", fact("english_requirement", "summary", summary, confidence=0.58)))


def round_name(lowered: Column) -> Column:
    return F.when(lowered.contains("early"), "early").when(fn.contains_any(lowered, ["regular", "main round"]), "regular").when(lowered.contains("late"), "late").otherwise("")


def deadlines(body: Column, limit: int = 4) -> Column:
    """The first dated deadline sentences: struct (date_text, round_name, degree_level, text, confidence)."""

    def shaped(sentence: Column) -> Column:
        low = F.lower(sentence)
        date = F.regexp_extract(sentence, f"(?i){lx.DATE}", 0)
        name = round_name(low)
        return F.when(fn.contains_any(low, ["deadline", "apply by"]) & (date != ""), F.struct(
            date.alias("date_text"), name.alias("round_name"), fn.first_tag(low, lx.STUDY_LEVELS).alias("degree_level"),
            F.substring(sentence, 1, 500).alias("text"), F.when(name != "", "0.72").otherwise("0.62").alias("confidence"),
        ))

    found = F.transform(F.transform(fn.sentences(body), fn.clean_sentence), shaped)
    return F.slice(F.filter(found, lambda d: d.isNotNull()), 1, limit)


def application_facts(body: Column, lowered: Column) -> Column:
    system = F.coalesce(*[F.when(fn.contains_any(lowered, words), F.lit(name)) for name, words in lx.APPLICATION_SYSTEMS.items()])
    flags = present(
        F.when(system.isNotNull(), fact("application", "application_system", system, confidence=0.7)),
        F.when(lowered.contains("rolling admission"), fact("application", "rolling_admission", "true", confidence=0.75)),
        F.when(lowered.contains("portfolio"), fact("application", "portfolio_required", "true", confidence=0.62)),
        F.when(lowered.contains("interview"), fact("application", "interview_required", "true", confidence=0.58)),
    )

    def dated(d: Column) -> Column:
        payload = fn.json_object(date_text=fn.json_text(d["date_text"]), parsed_date=F.lit('""'), round_name=fn.json_text(d["round_name"]), degree_level=fn.json_text(d["degree_level"]), text=fn.json_text(d["text"]), confidence=F.regexp_replace(d["confidence"], "0$", ""))
        return fact("application", "application_deadline_candidate", d["text"], payload, confidence=d["confidence"])

    return F.concat(flags, F.transform(deadlines(body), dated))


def certificate_facts(body: Column) -> Column:
    """One fact for each certificate whose first mention stands among words of admission, 120 characters to both sides."""

    def mention(key: str, core: str) -> Column:
        before = F.length(F.regexp_extract(body, f"(?is)^.*?(?={core})", 0))
        return F.when(body.rlike(f"(?is){core}"), F.struct(F.lit(key).alias("key"), F.regexp_extract(body, f"(?is){core}", 0).alias("raw"), before.alias("before")))

    # step by step, as in money_matches; certificates that the text doesn't name end with the first step
    def read(m: Column) -> Column:
        side = F.least(m["before"], F.lit(120))
        return F.struct(m["key"].alias("key"), m["raw"].alias("raw"), fn.clean_sentence(F.substr(body, m["before"] - side + 1, side + F.length(m["raw"]) + 120)).alias("context"))

    def lowered(m: Column) -> Column:
        return F.struct(m["key"].alias("key"), m["raw"].alias("raw"), m["context"].alias("context"), F.lower(m["context"]).alias("low"))

    def holds(m: Column) -> Column:
        upper = ~m["key"].isin(*lx.UPPER_CERTIFICATES) | (m["raw"] == F.upper(m["raw"]))
        step = (m["key"] != "STEP") | fn.contains_any(m["low"], lx.STEP_WORDS)
        return upper & ~fn.contains_any(m["low"], lx.CERTIFICATE_EXCLUDED) & fn.contains_any(m["low"], lx.CERTIFICATE_WORDS) & step

    def made(m: Column) -> Column:
        sure = F.when(fn.contains_any(m["low"], lx.CERTIFICATE_FIRM), "0.72").when(fn.contains_any(m["low"], lx.CERTIFICATE_SOFT), "0.60").otherwise("0.52")
        payload = fn.json_object(cert=fn.json_text(m["key"]), context=fn.json_text(F.substring(m["context"], 1, 240)))
        return fact("cert_requirement", m["key"], m["key"], payload, confidence=sure)

    named = present(*[mention(key, f"(?:{core})") for key, core in lx.CERTIFICATES.items()])
    return F.transform(F.filter(F.transform(F.transform(named, read), lowered), holds), made)


def scholarship_facts(lowered: Column) -> Column:
    named = keyword_fact(lowered, "support", "scholarship", lx.SUPPORTS["scholarship"])
    yes = F.array(fact("scholarship", "scholarship_available", "true", confidence=0.68))
    no = F.array(fact("scholarship", "scholarship_available", "false", confidence=0.55))
    # a text that denies scholarships names them too, so the denial decides only where no keyword is found
    return F.when(F.size(named) > 0, F.concat(named, yes)).when(fn.contains_any(lowered, ["no scholarship", "not offer scholarships"]), no).otherwise(F.array().cast(PARTS))


def catalogue_facts(lowered: Column) -> Column:
    return F.concat(tag_facts(lowered, "program", "field_of_study", lx.SUBJECTS, 0.58), tag_facts(lowered, "program", "degree_level", lx.STUDY_LEVELS, 0.58))


def facts_of(body: Column, source_type: Column) -> Column:
    """All facts of one text of a source type, in the order of the extractors."""
    low = F.lower(body)
    none = F.array().cast(PARTS)
    own = (
        F.when(source_type == "tuition_fees", money_facts(body)).when(source_type == "cost_of_living", money_facts(body, "living_cost")).when(source_type == "english_requirements", english_facts(body))
        .when(source_type.isin(*lx.ADMISSIONS), F.concat(application_facts(body, low), certificate_facts(body))).when(source_type == "scholarships", scholarship_facts(low))
        .when(source_type == "program_catalog", catalogue_facts(low)).when(source_type == "housing", keyword_fact(low, "support", "housing_support", ["housing", "accommodation", "residence"]))
        .when(source_type == "career", keyword_fact(low, "support", "career_services", ["career", "employability", "internship"])).otherwise(none)
    )
    return F.concat(common_tags(low, source_type), own)


def usable_texts(sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """Usable evidence with the type of its source (the last of its id)."""
    kinds = last_wins(ordered(sources), "source_id").select(text("source_id").alias("_sid"), text("source_type").alias("source_type"))
    rows = ordered(evidence).filter(usable(evidence)).select("evidence_id", "source_id", "university_id", "url", text("extracted_text").alias("extracted_text"), ORDER)
    return rows.join(kinds, text("source_id") == F.col("_sid"), "left").drop("_sid").withColumn("source_type", text("source_type"))


def facts(sources: DataFrame, evidence: DataFrame, run_ts: str) -> DataFrame:
    """Facts of all usable evidence, with ids; `_ord` keeps the reading order (text, then place in the text)."""
    found = usable_texts(sources, evidence).select("evidence_id", "university_id", "url", ORDER, F.posexplode(facts_of(F.col("extracted_text"), F.col("source_type"))).alias("_place", "_f"))
    f = F.col("_f")
    shaped = found.select(
        fn.stable_id("fact", F.col("evidence_id"), f["fact_type"], f["fact_key"], f["value_text"], f["value_json"], F.when(f["value_number"].isin("0", "0.0"), "").otherwise(f["value_number"])).alias("fact_id"),
        text("university_id").alias("university_id"), F.lit("").alias("program_id"), *[f[c].alias(c) for c in ("fact_type", "fact_key", "value_text", "value_json", "value_number", "value_currency", "value_date", "fact_origin")],
        text("evidence_id").alias("evidence_id"), text("url").alias("source_url"), *[f[c].alias(c) for c in ("supporting_text", "confidence_score", "review_status")],
        F.lit(run_ts).alias("extracted_at"), F.struct(ORDER, "_place").alias(ORDER),
    )
    return shaped.select(*FACT, ORDER)


def in_order(df: DataFrame) -> DataFrame:
    """Facts in the order of the exports."""
    return df.orderBy("university_id", "fact_type", "fact_key", "source_url", ORDER)


def programs(sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """Programme mentions in catalogue texts: at most 20 a text, repeats kept."""
    texts = usable_texts(sources, evidence).filter(F.col("source_type") == "program_catalog")
    named = F.transform(F.slice(F.regexp_extract_all("extracted_text", F.lit(f"(?i){lx.PROGRAM_NAME}"), 1), 1, 20), fn.clean_sentence)
    found = texts.select("university_id", "url", ORDER, F.posexplode(named).alias("_place", "name"))
    low = F.lower("name")
    made = {
        "program_id": fn.stable_id("program", F.col("university_id"), F.col("name")), "university_id": text("university_id"), "name": F.col("name"), "normalized_name": low,
        "degree_level": fn.first_tag(low, lx.STUDY_LEVELS), "field_of_study": fn.first_tag(low, lx.SUBJECTS), "program_url": text("url"), "status": F.lit("needs_review"),
    }
    return found.select(*[made.get(c, F.lit("")).alias(c) for c in PROGRAM], F.struct(ORDER, "_place").alias(ORDER))


def extracted(df: DataFrame) -> DataFrame:
    return df.filter(text("fact_origin").isin(*lx.EXTRACTED_ORIGINS))


def generated(df: DataFrame) -> DataFrame:
    return df.filter(~text("fact_origin").isin(*lx.EXTRACTED_ORIGINS))


def from_model(df: DataFrame) -> DataFrame:
    return df.filter(text("fact_origin") == lx.LLM_ORIGIN)


def merge(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Both sets, existing ones first; of facts with one id the first stays, blank ids all stay."""
    side = lambda df, k: ordered(df).select(*FACT, F.concat(F.array(F.lit(k).cast("long")), order_key(ordered(df))).alias(ORDER))
    rows = side(existing, 0).unionByName(side(added, 1))
    named, unnamed = rows.filter(text("fact_id") != ""), rows.filter(text("fact_id") == "")
    picked = named.groupBy("fact_id").agg(F.min_by(F.struct(*[c for c in FACT if c != "fact_id"], ORDER), ORDER).alias("r")).select("fact_id", "r.*")
    return picked.select(*FACT, ORDER).unionByName(unnamed.select(*FACT, ORDER))

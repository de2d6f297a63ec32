"""Facts from a language model's structured answers: routing, gates, merging. The client is injected."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena import functions as fn
from provena.materialize import removed, written
from provena.operators import order_stats
from provena.operators.quality import usable
from provena.schemas import EVIDENCE, FACT, LLM_REPORT, ORDER, conform, last_wins, ordered, text

#: client(prompt, context) -> answer (JSON value); context has source_type, university_id, url.
Client = Callable[[str, dict], object]
MAX_CHARS = 45_000
# Groups of an answer, the fields of their items, and names that route loose items.
GROUPS = ("tuition_facts", "deadline_facts", "english_requirement_facts", "cert_requirement_facts", "application_facts", "scholarship_facts", "program_facts")
FIELDS = (
    "supporting_text", "display_text", "confidence_score", "amount_min", "amount_max", "currency", "billing_unit", "student_type", "degree_level", "academic_year", "date_text", "parsed_date", "round_name", "intake",
    "application_system", "rolling_admission", "portfolio_required", "interview_required", "test", "overall_score", "min_band", "cert", "requirement_type", "scholarship_available", "field_of_study", "program_name",
)
ROUTES = {
    "tuition_facts": ("tuition", "tuition_fee"), "deadline_facts": ("deadline", "application_deadline", "application_deadline_candidate"), "english_requirement_facts": ("english", "english_requirement"),
    "cert_requirement_facts": ("cert", "certificate", "cert_requirement"), "application_facts": ("application", "admission"), "scholarship_facts": ("scholarship", "financial_aid"), "program_facts": ("program", "programme"),
}
MARKS = (
    ("tuition_facts", ("amount_min", "currency")), ("deadline_facts", ("date_text", "parsed_date")), ("english_requirement_facts", ("test", "overall_score")), ("cert_requirement_facts", ("cert", "requirement_type")),
    ("application_facts", ("application_system", "rolling_admission", "portfolio_required", "interview_required")), ("scholarship_facts", ("scholarship_available",)), ("program_facts", ("program_name", "field_of_study")),
)
ALLOWED = {
    "tuition_facts": ("tuition_fees",), "deadline_facts": ("undergraduate_admissions", "graduate_admissions", "international_admissions"), "application_facts": ("undergraduate_admissions", "graduate_admissions", "international_admissions"),
    "english_requirement_facts": ("english_requirements", "undergraduate_admissions", "international_admissions"), "cert_requirement_facts": ("english_requirements", "undergraduate_admissions", "international_admissions"),
    "scholarship_facts": ("scholarships", "undergraduate_admissions", "international_admissions"), "program_facts": ("program_catalog",),
}
TESTS = {"ielts": "IELTS", "toefl": "TOEFL", "toefl ibt": "TOEFL", "pte": "PTE", "duolingo": "Duolingo", "cambridge english": "Cambridge English"}
INSTRUCTIONS = (
    "Extract only facts that the page text supports, each with a verbatim quote.\n"
    "Tuition means tuition or programme fees, never housing, deposits, aid, income or total cost. English tests are IELTS, TOEFL, PTE, Duolingo and Cambridge English; "
    "other examinations are certificate requirements. A deadline needs its date text. Leave out whatever is unsure."
)


def prompt(source_type: str, university_id: str, url: str, body: str) -> str:
    return f"{INSTRUCTIONS}\n\nSource type: {source_type}\nInstitution: {university_id}\nURL: {url}\n\nPage text:\n{body[:MAX_CHARS]}\n"


def answer_schema() -> dict:
    """JSON schema of an answer: seven arrays of items with nullable fields."""
    kinds = {"confidence_score": "number", "amount_min": "number", "amount_max": "number", "overall_score": "number", "rolling_admission": "boolean", "portfolio_required": "boolean", "interview_required": "boolean", "scholarship_available": "boolean"}
    item = {"type": "object", "additionalProperties": False, "required": list(FIELDS), "properties": {f: {"type": [kinds.get(f, "string"), "null"]} for f in FIELDS}}
    return {"type": "object", "additionalProperties": False, "required": list(GROUPS), "properties": {g: {"type": "array", "items": item} for g in GROUPS}}


def route(item: dict) -> str:
    """The group of a loose item: by its type, else by the first field that marks one."""
    named = str(item.get("fact_type") or item.get("type") or "").strip().lower()
    for group, names in ROUTES.items():
        if named in names:
            return group
    for group, fields in MARKS:
        unset = ("", None, False) if group == "application_facts" else (None,) if group == "scholarship_facts" else ("", None)
        if any(not any(item.get(f) is u or (u == "" and item.get(f) == "") for u in unset) for f in fields):
            return group
    return ""


def grouped(answer: object) -> dict[str, list]:
    """An answer in the form of GROUPS, whatever form it came in: groups, a list of facts, or loose items."""
    out: dict[str, list] = {g: [] for g in GROUPS}
    if isinstance(answer, dict):
        for g in GROUPS:
            if isinstance(answer.get(g), list):
                out[g] = list(answer[g])
        if not any(out.values()) and isinstance(answer.get("facts"), list):
            return grouped(answer["facts"])
    elif isinstance(answer, list):
        for item in (x for x in answer if isinstance(x, dict)):
            nested = [g for g in GROUPS if isinstance(item.get(g), list)]
            for g in nested:
                out[g] += item[g]
            if not nested and (g := route(item)):
                out[g].append(item)
    return out


def plan(sources: DataFrame, evidence: DataFrame, limit: int = 0, offset: int = 0, source_types: Sequence[str] | None = None) -> DataFrame:
    """Evidence with source_type and `skip`: why a row isn't sent (blank: it is).

    Rows are neither sorted nor numbered: the order values at which the offset ends and the limit is reached
    are found by counting (see order_stats), when this is called.
    """
    kinds = last_wins(ordered(sources), "source_id").select(text("source_id").alias("_sid"), text("source_type").alias("source_type"))
    rows = conform(ordered(evidence), EVIDENCE)
    rows = rows.join(kinds, F.col("source_id") == F.col("_sid"), "left").drop("_sid").withColumn("source_type", text("source_type"))
    filtered = F.lit(False) if not source_types else ~F.col("source_type").isin(*source_types)
    rows = rows.withColumn("skip", F.when(filtered, "source type filtered").when(~usable(rows, strict=True), "non-usable evidence").otherwise(""))
    if not limit and not offset:
        return rows
    sent = written(rows.filter("skip = ''").select(ORDER))
    first, last = (order_stats.nth(sent, ORDER, n) if n else None for n in (offset, limit and offset + limit))
    removed(sent)
    none = F.lit(False)
    before, after = none if first is None else F.col(ORDER) <= first, none if last is None else F.col(ORDER) > last
    late = F.when(before, "llm offset skipped").when(after, "llm limit reached").otherwise("")
    return rows.withColumn("skip", F.when(F.col("skip") != "", F.col("skip")).otherwise(late))


def ask(planned: DataFrame, client: Client, pause: float = 0.0) -> DataFrame:
    """planned with `answer` (grouped JSON) and `failure`; one call for each row that isn't skipped. Materialise before use: calls cost."""
    import time

    schema = f"{', '.join(f'{c} string' for c in EVIDENCE)}, {ORDER} long, source_type string, skip string, answer string, failure string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for row in batch.to_dict("records"):
                answer = failure = ""
                if not row["skip"]:
                    try:
                        context = {k: row[k] for k in ("source_type", "university_id", "url")}
                        found = grouped(client(prompt(**context, body=row["extracted_text"]), context))
                        answer = json.dumps({g: [x for x in items if isinstance(x, dict)] for g, items in found.items()}, ensure_ascii=False)
                    except Exception as error:  # noqa: BLE001  a failed call is a report row
                        failure = str(error) or type(error).__name__
                    if pause:
                        time.sleep(pause)
                got.append((answer, failure))
            yield batch.reset_index(drop=True).assign(answer=[g[0] for g in got], failure=[g[1] for g in got])

    return planned.select(*EVIDENCE, ORDER, "source_type", "skip").mapInPandas(run, schema)


def quoted(quote: Column, body: Column) -> Column:
    """Whether a quote of eight characters or more is in the text, white space and case aside."""
    flat = lambda c: F.lower(fn.squeeze(c))
    return (F.length(fn.squeeze_ends(quote)) >= 8) & F.contains(flat(body), flat(quote))


def number(value: Column) -> Column:
    """A number as text, whole ones without a point; blank for anything else."""
    as_double = value.try_cast("double")
    return F.when(as_double.isNull(), "").when(as_double == F.floor(as_double), as_double.cast("long").cast("string")).otherwise(as_double.cast("string"))


def said(value: Column) -> Column:
    """true for a yes in any accepted form, else the text itself."""
    return F.when(F.lower(F.trim(value)).isin("true", "yes", "required", "available"), "true").otherwise(F.trim(value))


def tagged_items(group: str, kind: str) -> Column:
    """The items of one group of an answer, each with the group's name."""
    items = F.coalesce(F.col(f"g.{group}"), F.array().cast(kind))
    return F.transform(items, lambda x: F.struct(F.lit(group).alias("group"), x.alias("x")))


def facts(answered: DataFrame, run_ts: str) -> DataFrame:
    """Facts of the answers that pass the gates: source type, quote, and what each group needs."""
    item_type = "array<struct<" + ", ".join(f"{f}: string" for f in FIELDS) + ">>"
    groups = F.from_json("answer", ", ".join(f"{g} {item_type}" for g in GROUPS))
    rows = answered.filter("answer <> ''").withColumn("g", groups)
    tagged = F.concat(*[tagged_items(g, item_type) for g in GROUPS])
    items = rows.select("evidence_id", "university_id", "url", "extracted_text", "source_type", ORDER, F.posexplode(tagged).alias("_place", "i")).select("*", "i.group", "i.x").drop("i")
    allowed = F.lit(False)
    for g, kinds in ALLOWED.items():
        allowed = allowed | ((F.col("group") == g) & F.col("source_type").isin(*kinds))
    field = lambda f: text(f"x.{f}")
    kept = items.filter(allowed & quoted(field("supporting_text"), F.col("extracted_text")))
    raw = lambda f: fn.json_text(field(f))
    source = fn.json_text(F.col("source_type"))
    low, high = number(F.col("x.amount_min")), number(F.col("x.amount_max"))
    high = F.when(high.isin("", "0"), low).otherwise(high)
    currency = F.upper(F.when(field("currency") == "", "USD").otherwise(field("currency")))
    test = F.coalesce(fn.lookup(TESTS, F.lower(F.trim(field("test")))), F.trim(field("test")))
    score = number(F.col("x.overall_score"))
    cert = F.translate(F.upper(F.trim(field("cert"))), "- ", "__")
    cert = F.when(cert == "A_LEVELS", "A_LEVEL").otherwise(cert)
    shown = lambda default: F.when(field("display_text") != "", field("display_text")).otherwise(default)

    def made(fact_type: str, key: Column | str, value: Column, payload: Column, sure: float, ok: Column, n: Column | str = "", code: Column | str = "", date: Column | str = "") -> Column:
        col = lambda v: v if isinstance(v, Column) else F.lit(v)
        confidence = F.coalesce(F.col("x.confidence_score").try_cast("double"), F.lit(sure))
        confidence = fn.two_decimals(F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)))
        return F.when(ok, F.struct(F.lit(fact_type).alias("fact_type"), col(key).alias("fact_key"), value.alias("value_text"), payload.alias("value_json"), col(n).alias("value_number"), col(code).alias("value_currency"), col(date).alias("value_date"), confidence.alias("confidence_score")))

    is_group = lambda g: F.col("group") == g
    flag = lambda f: (field(f) != "") & (field(f) != "false")
    options = [
        made("tuition", "tuition_fee", shown(field("supporting_text")), fn.json_object(min=low, max=high, currency=fn.json_text(currency), billing_unit=raw("billing_unit"), student_type=raw("student_type"), degree_level=raw("degree_level"), academic_year=raw("academic_year"), source_type=source), 0.72, is_group("tuition_facts") & (low != ""), low, currency),
        made("application", "application_deadline_candidate", shown(F.concat(F.when(field("round_name") == "", "Deadline").otherwise(field("round_name")), F.lit(": "), field("date_text"))), fn.json_object(date_text=raw("date_text"), parsed_date=raw("parsed_date"), round_name=raw("round_name"), intake=raw("intake"), degree_level=raw("degree_level"), text=raw("supporting_text"), source_type=source), 0.70, is_group("deadline_facts") & (field("date_text") != ""), date=field("parsed_date")),
        *[made("application", f, said(field(f)), fn.json_object(source_type=source), 0.62, is_group("application_facts") & flag(f)) for f in ("application_system", "rolling_admission", "portfolio_required", "interview_required")],
        made("english_requirement", test, F.concat_ws(" ", test, score), fn.json_object(test=fn.json_text(test), overall=score, min_band=raw("min_band"), degree_level=raw("degree_level")), 0.72, is_group("english_requirement_facts") & (test != "") & (score != ""), score),
        made("cert_requirement", cert, cert, fn.json_object(cert=fn.json_text(cert), requirement_type=raw("requirement_type"), degree_level=raw("degree_level")), 0.65, is_group("cert_requirement_facts") & (cert != "")),
        made("scholarship", "scholarship_available", said(field("scholarship_available")), fn.json_object(source_type=source), 0.62, is_group("scholarship_facts") & F.col("x.scholarship_available").isNotNull()),
        made("program", "field_of_study", field("field_of_study"), fn.json_object(program_name=raw("program_name"), degree_level=raw("degree_level")), 0.58, is_group("program_facts") & (field("field_of_study") != "")),
        made("program", "degree_level", field("degree_level"), fn.json_object(program_name=raw("program_name"), field_of_study=raw("field_of_study")), 0.58, is_group("program_facts") & (field("degree_level") != "")),
    ]
    found = kept.select("*", F.posexplode(F.filter(F.array(*options), lambda f: f.isNotNull())).alias("_nth", "f"))
    f = F.col("f")
    order = F.struct(F.col(ORDER).alias("at"), "_place", "_nth").alias(ORDER)
    made_columns = {
        "fact_id": fn.stable_id("fact", F.col("evidence_id"), f["fact_type"], f["fact_key"], f["value_text"], f["value_json"], F.lit("llm")), "university_id": F.col("university_id"), "program_id": F.lit(""), "fact_origin": F.lit("llm_extracted_from_source"),
        "evidence_id": F.col("evidence_id"), "source_url": F.col("url"), "supporting_text": field("supporting_text"), "review_status": F.lit("needs_review"), "extracted_at": F.lit(run_ts),
    }
    return found.select(*[made_columns[c].alias(c) if c in made_columns else f[c].alias(c) for c in FACT], order)


def report(answered: DataFrame, made: DataFrame, model: str) -> DataFrame:
    """One row for each row of evidence: ok, failed or skipped, with its facts counted and the reason."""
    counts = made.groupBy(F.col(f"{ORDER}.at").alias("_at")).agg(F.count("*").alias("_n"))
    rows = answered.join(counts, F.col(ORDER) == F.col("_at"), "left")
    state = F.when(F.col("skip") != "", "skipped").when(F.col("failure") != "", "failed").otherwise("ok")
    columns = {"source_url": F.col("url"), "status": state, "facts_emitted": F.coalesce("_n", F.lit(0)).cast("string"), "error": F.when(F.col("skip") != "", F.col("skip")).otherwise(F.col("failure")), "model": F.lit(model)}
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in LLM_REPORT], ORDER)

"""The pipeline's operators: examples with known results, and odd inputs."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from provena import cli, sinks
from provena import functions as fn
from provena import schemas as sc
from provena.operators import discovery, extract, llm_facts, name_index, order_stats, profiles, quality, rankings, source_map
from provena.sinks import csv_file
from provena.sources import fetch, html, json_records, models, split_csv, tables

NOW = "2026-01-01T00:00:00+00:00"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def source(sid="s1", kind="tuition_fees", **more):
    return {"source_id": sid, "university_id": "u", "university_name": "Uni", "country": "Japan", "source_type": kind, "url": f"https://u.edu/{sid}", "status": "fetched"} | more


def evidence(sid="s1", text="", **more):
    return {"evidence_id": f"e-{sid}", "source_id": sid, "university_id": "u", "url": f"https://u.edu/{sid}", "extracted_text": text, "status": "ok", "content_quality_status": "usable"} | more


def fact(kind, key, value="", payload="", **more):
    return {"fact_id": f"{kind}{key}{value}{payload}", "university_id": "u", "fact_type": kind, "fact_key": key, "value_text": value, "value_json": payload, "fact_origin": "extracted_from_source", "evidence_id": "e", "source_url": "https://u.edu"} | more


# functions


def test_stable_id(spark):
    assert one(spark, fn.stable_id("src", F.lit(" U "), F.lit(None), F.lit("x"))) == one(spark, fn.stable_id("src", F.lit("u"), F.lit(""), F.lit("X")))
    assert one(spark, fn.stable_id("src", F.lit("a"))).startswith("src_") and len(one(spark, fn.stable_id("src", F.lit("a")))) == 20


@pytest.mark.parametrize(("text", "rank"), [("1", "1"), ("=17", "17"), ("501-550", "501"), ("1201+", "1201"), ("", "")])
def test_rank_number(spark, text, rank):
    assert one(spark, fn.rank_number(F.lit(text))) == rank


@pytest.mark.parametrize(("name", "norm"), [("École Polytechnique (Paris)", "ecole polytechnique"), ("King’s College London", "king s college london"), ("A & B", "a and b")])
def test_normalize_name(spark, name, norm):
    assert one(spark, fn.normalize_name(F.lit(name))) == norm


def test_rounding_and_summaries(spark):
    assert [one(spark, fn.two_decimals(F.lit(x))) for x in (0.625, 0.6875, 1.0)] == ["0.62", "0.69", "1.00"]
    assert one(spark, fn.clean_summary(F.lit("  IELTS   7.0; "), 80)) == "IELTS 7.0"
    assert one(spark, fn.clean_summary(F.lit("Skip navigation IELTS 7.0"), 80)) == ""
    assert one(spark, fn.clean_summary(F.lit("alpha beta gamma"), 12)) == "alpha beta"
    assert one(spark, fn.json_object(b=F.lit("1"), a=fn.json_text(F.lit('q"\n')))) == '{"a": "q\\"\\n", "b": 1}'


@pytest.mark.parametrize(("url", "ok"), [("https://a.org", True), ("http:///x", False), ("file:///tmp/x", True), ("www.a.org", False), ("", False), (None, False)])
def test_valid_url(spark, url, ok):
    assert one(spark, fn.valid_url(F.lit(url).cast("string"))) is ok


def test_comparable_domain(spark):
    assert [one(spark, fn.comparable_domain(F.lit(h))) for h in ("www.ox.ac.uk:80", "a.b.edu", "localhost")] == ["ox.ac.uk", "b.edu", "localhost"]


# quality


@pytest.mark.parametrize(
    ("kind", "text", "fetched", "status"),
    [("housing", "x" * 900, "failed", "fetch_failed"), ("housing", "Access Denied", "fetched", "blocked"), ("housing", "Just a moment", "fetched", "js_challenge"), ("housing", "Page not found", "fetched", "not_found"), ("housing", "x" * 50, "fetched", "too_short"), ("housing", "x" * 500, "fetched", "too_short"), ("housing", "x" * 900, "fetched", "low_signal"), ("housing", "housing " * 120, "fetched", "usable"), ("ranking", "x" * 900, "fetched", "usable")],
)
def test_classify(spark, kind, text, fetched, status):
    assert one(spark, quality.classify(F.lit(kind), F.lit(""), F.lit(text), F.lit(fetched), F.lit("")))["status"] == status


def test_classify_evidence_takes_the_last_source(table):
    got = quality.classify_evidence(table(sc.SOURCE, source(kind="housing"), source(kind="ranking")), table(sc.EVIDENCE, evidence(text="x" * 900), evidence(sid="none", text="y"))).collect()
    assert {r["source_id"]: r["content_quality_status"] for r in got} == {"s1": "usable", "none": "too_short"}


# extraction


def facts_of(table, kind, text):
    return extract.facts(table(sc.SOURCE, source(kind=kind)), table(sc.EVIDENCE, evidence(text=text)), NOW).collect()


def test_money(table):
    got = [f for f in facts_of(table, "tuition_fees", "Annual tuition fee is US$ 30,000 to 40,000 per year. " + "x " * 150 + "Deposit of $ 5000 is due.") if f["fact_type"] == "tuition"]
    assert [(f["value_number"], f["value_currency"], f["value_text"]) for f in got] == [("30000", "USD", "US$ 30,000 to 40,000")]
    assert json.loads(got[0]["value_json"])["max"] == 40000 and got[0]["evidence_id"] and got[0]["source_url"] and got[0]["confidence_score"] == "0.74"


def test_english_and_certificates(table):
    got = {f["fact_key"]: f for f in facts_of(table, "english_requirements", "IELTS overall 7.0 is required. TOEFL iBT with sections of 20 or more.")}
    assert got["IELTS"]["value_text"] == "IELTS 7.0" and got["IELTS"]["value_number"] == "7.0" and "TOEFL_subscore" in got and "summary" in got
    admissions = {f["fact_key"] for f in facts_of(table, "undergraduate_admissions", "Submit SAT scores (required) with a portfolio. The next step in the application process is simple. Early application deadline is Nov 1, 2026.")}
    assert {"SAT", "portfolio_required", "application_deadline_candidate"} <= admissions and "STEP" not in admissions


def test_certificates_read_a_text_once_a_step(spark):
    """The first mention decides, with 120 characters to both sides; no step works a former one out again."""
    far = "\U0001f600" * 130
    texts = ["SAT", "Sat required, SAT", f"SAT {'x' * 130} required", f"{'y' * 119} GRE exam", "act score, ACT required", "step, STEP mathematics score", "A-levels, IB and Advanced Level accepted", f"{far} HSK may submit {far}", "", None]
    found = spark.createDataFrame(list(enumerate(texts)), "k long, t string").select("k", F.explode(extract.certificate_facts(F.col("t"))).alias("f"))
    got = sorted((r["k"], r["f"]["fact_key"], r["f"]["confidence_score"], len(json.loads(r["f"]["value_json"])["context"])) for r in found.collect())
    assert got == [(1, "SAT", "0.72", 17), (3, "GRE", "0.52", 128), (6, "A_LEVEL", "0.60", 40), (6, "IB", "0.60", 40), (7, "HSK", "0.60", 240)]
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") + plan.count("regexp_extract") <= 3 * len(extract.lx.CERTIFICATES)


def test_unusable_evidence_gives_nothing(table):
    rows = table(sc.EVIDENCE, evidence(text="tuition $ 20000", status="failed"), evidence(text="tuition $ 20000", content_quality_status="blocked"))
    assert extract.facts(table(sc.SOURCE, source()), rows, NOW).count() == 0
    assert extract.facts(table(sc.SOURCE), table(sc.EVIDENCE), NOW).count() == 0


def test_programs_and_tags(table):
    src, ev = table(sc.SOURCE, source(kind="program_catalog")), table(sc.EVIDENCE, evidence(text="Bachelor of Computer Science. Master of Law; end"))
    assert [(r["name"], r["degree_level"], r["field_of_study"]) for r in extract.programs(src, ev).orderBy(sc.ORDER).collect()] == [("Bachelor of Computer Science", "bachelor", "computer_science"), ("Master of Law", "master", "law")]
    assert "computer_science" in {f["value_text"] for f in extract.facts(src, ev, NOW).collect()}


def test_merge_keeps_existing(table):
    old, new = table(sc.FACT, fact("a", "k", fact_id="1", value_text="old"), fact("a", "k", fact_id="")), table(sc.FACT, fact("a", "k", fact_id="1", value_text="new"), fact("a", "k", fact_id="2"), fact("a", "k", fact_id=""))
    got = extract.merge(old, new)
    assert got.count() == 4 and got.filter("fact_id = '1'").first()["value_text"] == "old"


# profiles


def complete_facts(table):
    money = lambda lo, hi: json.dumps({"min": lo, "max": hi, "currency": "SGD"})
    return table(
        sc.FACT, fact("tuition", "tuition_fee", payload=money(30000, 40000)), fact("living_cost", "living_cost", payload=money(15000, 20000)), fact("matching", "subject_tag", "law"), fact("matching", "study_level_tag", "master"),
        fact("scholarship", "scholarship_available", "true"), fact("application", "application_system", "ucas"), fact("application", "application_deadline_candidate", payload=json.dumps({"date_text": "Nov 1", "round_name": "early"})),
        fact("english_requirement", "IELTS", "IELTS 7.0"), fact("english_requirement", "summary", "Skip navigation junk"), fact("cert_requirement", "SAT", "SAT"), fact("application", "portfolio_required", "true"),
    )


SEED = {"university_id": "u", "name": "Uni", "country": "Japan", "city": "Kyoto", "website_url": "https://u.edu", "type": "public"}


def test_profile(table):
    kinds = ["official_home", "undergraduate_admissions", "tuition_fees", "english_requirements"]
    sources = table(sc.SOURCE, *[source(f"s{k}", kind) for k, kind in enumerate(kinds)])
    proof = table(sc.EVIDENCE, *[evidence(f"s{k}") for k in range(4)])
    facts = complete_facts(table)
    built = profiles.build(table(sc.SEED, SEED, SEED | {"university_id": "v", "city": ""}), sources, facts, table(sc.RANKING_IMPORT, {"university_id": "u", "qs_rank": "7"}), table(sc.COUNTRY_COST, {"country": "Japan", "annual_living_usd_min": "12000", "annual_living_usd_max": "18000"}), proof)
    got = {r["university_id"]: r for r in built.collect()}
    u, v = got["u"], got["v"]
    assert (u["total_cost_usd_min"], u["import_status"], u["data_quality_score"], u["evidence_coverage_score"], u["qs_rank"]) == (33300, "ready_for_import", "1.00", "1.00", "7")
    assert (u["deadline_summary"], u["english_requirement_summary"], u["cert_requirement_summary"], u["portfolio_required"]) == ("Early: Nov 1", "IELTS 7.0", "SAT", True)
    assert u["requirement_summary"] == "Early: Nov 1; IELTS 7.0; SAT; Portfolio required" and u["writer_context"]["source_note"] == "Generated from pilot ingestion facts for Uni."
    assert (v["living_cost_usd_min"], v["living_cost_usd_max"], v["import_status"], v["qa_status"]) == (12000, 18000, "do_not_import", "needs_fact_repair")
    assert v["missing"] == ["city", "subject_tags", "study_level_tags", "tuition_usd_min", "tuition_usd_max", "scholarship_available", "application_system", "deadline_summary", "english_requirement_summary"]
    assert profiles.field_gaps(built).count() == 9
    gate = {r["metric"]: (r["value"], r["status"]) for r in profiles.quality_gate(built, facts).collect()}
    assert gate == {"universities_with_required_sources": ("0.50", "fail"), "facts_with_evidence_links": ("1.00", "pass"), "average_data_quality_score": ("0.72", "pass"), "matching_readiness_rate": ("0.50", "fail")}


def test_profile_prefers_model_facts(table):
    money = json.dumps({"min": 1000, "max": 2000, "currency": "USD"})
    facts = table(sc.FACT, fact("tuition", "tuition_fee", payload=json.dumps({"min": 9000, "max": 9000, "currency": "USD"})), fact("tuition", "tuition_fee", payload=money, fact_origin="llm_extracted_from_source"), fact("english_requirement", "IELTS", "IELTS 7.0"), fact("english_requirement", "TOEFL", "TOEFL 90", fact_origin="llm_extracted_from_source"))
    r = profiles.build(table(sc.SEED, SEED), table(sc.SOURCE), facts, table(sc.RANKING_IMPORT)).first()
    assert (r["tuition_usd_min"], r["tuition_usd_max"], r["english_requirement_summary"], r["living_cost_usd_min"]) == (1000, 2000, "TOEFL 90", None)


def test_empty_profiles(table):
    built = profiles.build(table(sc.SEED), table(sc.SOURCE), table(sc.FACT), table(sc.RANKING_IMPORT))
    assert built.count() == 0
    assert [r["value"] for r in profiles.quality_gate(built, table(sc.FACT)).collect()] == ["0.00", "1.00", "0.00", "0.00"]


# source maps


def test_normalize(table):
    rows = table(sc.SOURCE, source(university_id="mit_us", priority="", source_id=""), source(university_id="mit_us", source_id="again"), {}, source(url="nope"))
    assert source_map.normalize_stats(rows).first().asDict() == {"input_rows": 4, "output_rows": 1, "mapped_university_ids": 2, "removed_blank_rows": 1, "removed_invalid_url_rows": 1, "removed_exact_duplicates": 1}
    r = source_map.normalize(table(sc.SEED, SEED | {"university_id": "mit", "name": "MIT"}), rows).first()
    assert (r["university_id"], r["university_name"], r["priority"], r["language_code"], r["source_id"][:4]) == ("mit", "MIT", "2", "en", "src_")


def test_retry(table):
    rows = table(sc.SOURCE, source("a", status="failed"), source("b", "career", status="failed"), source("c", "official_home"))
    assert [(r["source_id"], r["status"]) for r in source_map.retry_map(rows, source_types=["tuition_fees"]).collect()] == [("a", "pending")]


def test_repairs(table):
    base = table(sc.SOURCE, source("a"), source("b"), source("c", "career"), source("d", university_id="w"))
    fixes = table(["university_id", "source_type", "New URL / Alternative", "crawl_method", "Action / Repair"], {"university_id": "u", "source_type": "tuition_fees", "New URL / Alternative": " (https://new.edu)", "Action / Repair": "moved"}, {"university_id": "u", "source_type": "housing", "New URL / Alternative": "https://h.edu"}, {"university_id": "w", "source_type": "all_sources", "crawl_method": "pdf"})
    got = {r["source_id"]: r for r in source_map.apply_repairs(table(sc.SEED, SEED), base, fixes).collect()}
    assert [got[k]["change"] for k in "abcd"] == ["updated", "", "", "updated"] and got["a"]["url"] == "https://new.edu" and got["a"]["notes"] == "moved" and got["d"]["crawl_method"] == "pdf"
    assert len(got) == 5 and all(r["status"] == "pending" for r in got.values())


def test_merge_crawl(table):
    base = table(sc.SOURCE, source("a", status="failed"), source("b", status="failed"), source("c"))
    got = source_map.merge_sources(base, table(sc.SOURCE, source("a", notes="new"), source("b", status="failed", notes="new"), source("c", status="failed"), source("z"))).orderBy(sc.ORDER).collect()
    assert [(r["source_id"], r["replaced"], r["notes"]) for r in got] == [("a", True, "new"), ("b", True, "new"), ("c", False, "")]


def test_validation(table):
    seed = table(sc.SEED, SEED)
    rows = table(sc.SOURCE, source("a"), source("b", url="https://u.edu/a"), source("c", "blog", url="bad", university_id="zz", priority="0"))
    said = [r["message"] for r in source_map.validate_sources(rows, seed).orderBy("row_number", "check").collect()]
    assert said == ["source row 3: duplicate source for u tuition_fees https://u.edu/a", "source row 4: university_id zz not present in seed", "source row 4: unsupported source_type blog", "source row 4: invalid url bad", "source row 4: priority must be >= 1"]
    assert source_map.validate_seed(seed).count() == 0
    assert [r["message"] for r in source_map.validate_seed(table(sc.SEED, SEED, SEED)).collect()] == ["seed row 3: duplicate university_id u"]
    assert source_map.validate_seed(table(sc.SEED)).first()["message"] == "seed CSV has no data rows"


def test_search_and_promotion(table, spark):
    asked = source_map.search_requests(table(sc.SEED, SEED), table(sc.SOURCE, source()), ["tuition_fees", "scholarships"])
    assert [r["search_query"] for r in asked.collect()] == ["Uni scholarships international students official"]
    hits = spark.createDataFrame([("Uni scholarships international students official", 1, "ftp://x", "", ""), ("Uni scholarships international students official", 2, "https://www.u.edu/scholarships", "Scholarships", "official")], "search_query string, rank int, link string, title string, snippet string")
    found = source_map.search_candidates(asked, hits).collect()
    assert [(r["rank"], r["confidence_score"], r["review_status"]) for r in found] == [("2", "0.77", "needs_review")]
    offers = table([*sc.SEARCH, "manual_url"], {"university_id": "u", "source_type": "career", "candidate_url": "https://u.edu/c", "review_status": "Approved", "crawl_method": "pdf"}, {"university_id": "u", "source_type": "career", "candidate_url": "https://u.edu/d", "review_status": "needs_review"}, {"university_id": "u", "source_type": "tuition_fees", "candidate_url": "(https://u.edu/s1)", "review_status": "approved"})
    got = source_map.promote(table(sc.SEED, SEED), table(sc.SOURCE, source()), offers).collect()
    assert [(r["url"], r["crawl_method"]) for r in got] == [("https://u.edu/s1", ""), ("https://u.edu/c", "pdf")]


# discovery


def test_links_and_candidates(table, spark):
    page = "<html><a href='/admissions/apply'>Apply now</a><a href='fees'>Tuition <b>and</b> fees</a><a href='https://other.org/fees'>Fees</a><a href='x.jpg'>apply</a></html>"
    df = spark.createDataFrame([("u", "Uni", "https://www.u.edu/", page)], "university_id string, university_name string, url string, html string")
    found = discovery.suggestions(discovery.links(df)).collect()
    assert {(r["candidate_source_type"], r["url"]) for r in found} == {("undergraduate_admissions", "https://www.u.edu/admissions/apply"), ("tuition_fees", "https://www.u.edu/fees")}
    offers = table(sc.SUGGESTION, *[{"university_id": "u", "candidate_source_type": k, "url": url, "confidence_score": s} for k, url, s in (("tuition_fees", "https://u.edu/1", "0.75"), ("tuition_fees", "https://u.edu/22", "0.75"), ("scholarships", "https://u.edu/1", "0.90"), ("scholarships", "https://u.edu/3", "0.55"))])
    got = discovery.candidate_map(table(sc.SOURCE, source("home", "official_home")), offers).collect()
    assert sorted((r["source_type"], r["url"]) for r in got) == [("official_home", "https://u.edu/home"), ("scholarships", "https://u.edu/3"), ("tuition_fees", "https://u.edu/1")]


# rankings


def ranked(*rows):
    return [{"institution_name": n, "country": c, "rank_raw": r} for n, c, r in rows]


def test_matching(table):
    seeds = table(sc.SEED, {"university_id": "mit", "name": "Massachusetts Institute of Technology", "country": "USA"}, {"university_id": "york", "name": "University of York", "country": "UK"}, {"university_id": "kept", "name": "Nowhere Institute", "country": "X"})
    rows = rankings.best_ranks(rankings.normalize(table(sc.RANKING_RAW, *ranked(("Massachusetts Institute of Technology (MIT)", "United States", "1"), ("York University", "Canada", "50"), ("Massachusetts Institute of Technology", "United States", "=2"), ("", "", "3"))), "2026-01-01"))
    assert rows.count() == 2 and rows.filter("normalized_name like 'massachusetts%'").first()["rank_raw"] == "1"
    found = rankings.candidates(seeds, rows)
    imports, report = rankings.match(seeds, found, table(sc.RANKING_IMPORT, {"university_id": "kept", "qs_rank": "99"}))
    assert {r["university_id"]: (r["match_status"], r["qs_rank"]) for r in report.collect()} == {"mit": ("matched", "1"), "york": ("ambiguous", ""), "kept": ("existing_preserved", "99")}
    assert imports.filter("university_id = 'mit'").first()["review_status"] == "approved"


def test_filter_before_the_ratio_loses_nothing(spark):
    words = ["north", "south", "tech", "college", "universitat", "universidad", "state", "stat", "norte", "cologne", "colombo", "the", ""]
    names = sorted({f"{a} {b}".strip() for a in words for b in words})
    pairs = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    for side in "ab":
        pairs = pairs.withColumn(f"n_{side}", rankings.letter_counts(F.col(side)))
    bound = F.coalesce(rankings.ratio_bound(F.col("a"), F.col("b"), F.col("n_a"), F.col("n_b")), F.lit(1.0))
    assert pairs.filter(bound < rankings.sequence_ratio("a", "b") - 1e-9).count() == 0
    assert pairs.filter(bound < 0.5).count() > 0


def made_up_names(rng, n):
    parts = ["North", "Norte", "Nord", "Tech", "Technical", "College", "Colombo", "Universitat", "Universidad", "University", "of", "The", "State", "Stat", "São", "A", "Q", "Zz", "7", "Institute", "Instituto", "Nordic", "(X)"]
    names = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(n)]
    return names + ["".join(rng.choice("abc de") for _ in range(rng.randint(0, 9))) for _ in range(n)] + [names[0][1:], names[1] + "s", names[2][::-1], "", "The Of", "At In"]


def test_candidates_equal_the_full_product(table, monkeypatch):
    """Only pairs that can reach a score meet, and all of them: as many candidates as from every pair."""
    rng = random.Random(4)
    pick = lambda: rng.choice(["X", "Y", "", "UK", "United Kingdom"])
    seeds = table(sc.SEED, *[{"university_id": f"u{k}", "name": n, "local_name": rng.choice(["", "", "Norte Tech"]), "country": pick(), "city": rng.choice(["", "C", "D"])} for k, n in enumerate(made_up_names(rng, 25))])
    rows = rankings.normalize(table(sc.RANKING_RAW, *[{"institution_name": n, "country": pick(), "city": rng.choice(["", "C"]), "rank_raw": str(k)} for k, n in enumerate(made_up_names(rng, 60))]), "2026-01-01")
    columns = ("university_id", "q_ord", "match_reason", "score", "place", "next_score")
    shown = lambda: sorted((tuple(r) for r in rankings.candidates(seeds, rows).select(*columns).collect()), key=str)
    got = shown()
    monkeypatch.setattr(rankings, "name_pairs", lambda a, b: a.crossJoin(b))
    monkeypatch.setattr(rankings, "hopeful", lambda pairs: pairs)
    assert got == shown() and len(got) > 200 and len({r[2] for r in got}) >= 3


def test_names_meet_over_equal_keys(spark):
    """No nested loop in the plan, and no pair below its bounds lost: against all pairs of names and difflib."""
    from difflib import SequenceMatcher

    rng = random.Random(9)
    sides = [[" ".join(n.lower().replace("(x)", "x").split()) for n in made_up_names(rng, 70)] for _ in range(2)]
    left, right = (spark.createDataFrame([(n, rng.choice("=x =y *".split())) for n in side], "name string, scope string") for side in sides)
    met = name_index.meeting(left, right, (0.6, 0.62), 0.88)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {tuple(r) for r in met.collect()}
    scopes = [{}, {}]
    for of, df in zip(scopes, (left, right), strict=True):
        for n, s in df.collect():
            of.setdefault(n, set()).add(s)
    assert len(got) < 0.6 * len(scopes[0]) * len(scopes[1])
    for a in scopes[0]:
        for b in scopes[1]:
            ratio, x, y = SequenceMatcher(None, a, b).ratio(), set(a.split()), set(b.split())
            if a == b or ratio >= 0.88 or (x and y and len(x & y) >= 0.6 * min(len(x), len(y))) or (ratio >= 0.62 and scopes[0][a] & scopes[1][b]):
                assert (a, b) in got, (a, b, ratio)


def test_kinds_of_names_are_judged_once(spark, monkeypatch):
    """Repeated rows cost nothing before the last joins, and every pair of rows that holds is there: against all pairs of rows."""
    from collections import Counter

    rng = random.Random(3)
    left = [(k, rng.choice(["norte tech", "nord stat", ""]), rng.choice(["x", "y", None]), rng.choice(["c", "", None])) for k in range(150)]
    right = [(k, rng.choice(["nord tech", "norte tech", "tech stat x", "q", ""]), *rng.choice([("X", "x"), ("Y", "y"), ("", ""), (None, None)]), rng.choice(["c", None])) for k in range(200)]
    names = spark.createDataFrame(left, "id long, simple string, country_key string, city_key string")
    ranked = spark.createDataFrame(right, "q_ord long, q_simple string, q_country string, q_country_key string, q_city_key string")
    judged, hopeful = [], rankings.hopeful
    monkeypatch.setattr(rankings, "hopeful", lambda pairs: judged.append(pairs.count()) or hopeful(pairs))
    pairs = rankings.name_pairs(names, ranked)
    got = Counter(tuple(r) for r in pairs.select("id", "q_ord", "shared_letters").collect())
    assert len(judged) == 1 and judged[0] <= len({r[1:] for r in left}) * len({r[1:] for r in right}) < len(left) * len(right) / 10

    def letters(a, b):
        return sum((Counter(a) & Counter(b)).values())

    def holds(a, country, city, b, q_country, q_key, q_city):
        x, y = set(a.split()), set(b.split())
        both = len(x & y)
        score = max(2 * letters(a, b) / max(len(a + b), 1) * 0.76, both / max(len(x | y), 1) * 0.82, both / max(min(len(x), len(y)), 1) * 0.78)
        near = q_country == "" or (country is not None and country == q_key)
        return a == b or score >= 0.62 - (0.12 if near else -0.08) - (0.03 if city and city == q_city else 0) - 0.002

    assert got == Counter((a[0], b[0], letters(a[1], b[1])) for a in left for b in right if holds(*a[1:], *b[1:])) and 1000 < len(got) < 25000


def test_pairs_of_a_hot_kind_are_spread(spark, monkeypatch):
    """Rows of one kind lie in bounded blocks, whose pairs are made after the last shuffle, in tasks by what they return."""
    from collections import Counter

    monkeypatch.setattr(rankings, "RIGHT_ROWS", 32, raising=False)
    monkeypatch.setattr(rankings, "MANY_ROWS", 10_000, raising=False)
    left = [(k // 2, "nord tech", "x", None) for k in range(300)] + [(k, "zq", None, "c") for k in range(9)]
    right = [(k // 3, "nord tech", "", None, None) for k in range(1100)] + [(5000 + k, "nord tech", "X", "x", "c") for k in range(2)] + [(9000, "ab", "", "", "")]
    names = spark.createDataFrame(left, "id long, simple string, country_key string, city_key string")
    ranked = spark.createDataFrame(right, "q_ord long, q_simple string, q_country string, q_country_key string, q_city_key string")
    pairs = rankings.name_pairs(names, ranked)
    got = {(r.id, r.q_ord): r["count"] for r in pairs.groupBy("id", "q_ord").count().collect()}
    one, two = Counter(r[0] for r in left[:300]), Counter(r[0] for r in right[:1102])
    assert got == {(a, b): one[a] * two[b] for a in one for b in two}
    spread = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(spread) > 8 and max(spread) < sum(spread) / 4
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Exchange") and plan.index("Generate explode") < plan.index("Join")
    sizes = [(r.left_n, len(r.left_rows), r.simple) for r in rankings.blocks(names, rankings.SEED_KIND, "left", 64).collect()]
    assert max(n for n, _, _ in sizes) <= 64 and all(n == m for n, m, _ in sizes) and Counter(s for n, _, s in sizes for _ in range(n)) == Counter(r[1] for r in left)
    none = rankings.name_pairs(names.limit(0), ranked)
    assert none.columns == pairs.columns and none.count() == 0


def test_fetched_rankings(spark, tmp_path):
    page = json.dumps([{"title": f"Univ {k}", "rank": str(k)} for k in range(1, 4)]).encode()

    def fetch_page(url, seconds):
        if url.endswith("json"):
            raise OSError("refused")
        return page, "application/json"

    def run(name, *options, **clients):
        out = tmp_path / name
        assert cli.main(["fetch-qs-rankings", "--out-dir", str(out), *options], cli.Clients(fetch=fetch_page, **clients), spark) == 0
        return out, {p.name for p in out.iterdir()}, tables.read_csv(spark, str(out / "qs_normalized.csv")).count()

    out, files, n = run("plain", "--no-playwright")
    assert n == 3 and {f"qs_official_response_{k}.txt" for k in (1, 3, 4, 5)} < files and "refused" in (out / "fetch_qs_static_error.txt").read_text() and not any("playwright" in f for f in files)
    out, files, n = run("browser", capture=lambda url, seconds: ("<html></html>", [{"data": [{"name": "Univ 9", "rank": 9}]}]))
    assert n == 4 and {"qs_playwright_page.html", "qs_playwright_payloads.json"} < files
    out, files, n = run("none")
    assert n == 3 and "playwright" in (out / "fetch_qs_playwright_error.txt").read_text()


def test_ranking_files(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("﻿Some title,,\n,,\n2026 Rank,University Name,Country/Territory\n=17,<b>École</b> X,France\n,,\n501-550,Y,\n", encoding="utf-8")
    rows = tables.ranking_rows(tables.read_rankings(spark, str(path)), "f", "2026-01-01").orderBy(sc.ORDER)
    got = rankings.normalize(rows, "2026-01-01").orderBy(sc.ORDER).collect()
    assert [(r["institution_name"], r["rank_numeric"], r["rank_display"], r["review_status"]) for r in got] == [("École X", "17", "QS 2026 #=17", "approved"), ("Y", "501", "QS 2026 #501-550", "needs_review")]


def test_json_records(spark):
    page = '<script type="application/json">{"a": [{"title": "U &amp; V", "rank_display": "5", "city": "C"}, {"name": "no rank"}]}</script><script>window.__NEXT_DATA__ = {"name": "W", "rank": 3, "x": "}"};</script>'
    assert [(r[0], r[1]) for r in json_records.records_of_text(page)] == [("5", "U & V"), ("3", "W")]
    assert rankings.records(spark.createDataFrame([(page,), (None,), (page,)], "body string")).count() == 2


# model answers


def test_model_answers(table):
    body = "Tuition for international students is 20,000 USD a year. Apply by 1 March 2026."
    sources = table(sc.SOURCE, source("a"), source("b", "career"), source("c"))
    rows = table(sc.EVIDENCE, evidence("a", body), evidence("b", body), evidence("c", body, content_quality_status="blocked"))
    quote = {"supporting_text": "tuition for  international students", "amount_min": 20000, "currency": "usd"}

    def client(prompt, context):
        if context["source_type"] == "career":
            raise RuntimeError("no")
        return [quote, quote | {"supporting_text": "not on the page at all"}, {"date_text": "1 March 2026", "supporting_text": "Apply by 1 March 2026"}]

    answered = llm_facts.ask(llm_facts.plan(sources, rows), client).cache()
    made = llm_facts.facts(answered, NOW)
    assert [(r["fact_type"], r["value_number"], r["value_currency"]) for r in made.collect()] == [("tuition", "20000", "USD")]
    said = {r["source_id"]: (r["status"], r["facts_emitted"], r["error"]) for r in llm_facts.report(answered, made, "m").collect()}
    assert said == {"a": ("ok", "1", ""), "b": ("failed", "0", "no"), "c": ("skipped", "0", "non-usable evidence")}
    reasons = [r["skip"] for r in llm_facts.plan(sources, table(sc.EVIDENCE, *[evidence("a", body)] * 3), limit=1, offset=1).orderBy(sc.ORDER).collect()]
    assert reasons == ["llm offset skipped", "", "llm limit reached"]


@pytest.mark.parametrize(("provider", "reply"), [("openai", {"choices": [{"message": {"content": '{"tuition_facts": []}'}}]}), ("gemini", {"candidates": [{"content": {"parts": [{"text": '{"tuition_'}, {"text": 'facts": []}'}]}}]})])
def test_providers(provider, reply):
    sent = []

    def transport(url, headers, body, seconds):
        sent.append((url, headers, json.loads(body), seconds))
        return 200, json.dumps(reply).encode()

    env = {"LLM_REQUEST_TIMEOUT": "soon", f"{provider.upper()}_API_KEY": "secret", f"{provider.upper()}_MODEL": "m1"}
    assert models.client(transport, provider.upper(), env=env)("the prompt", {}) == {"tuition_facts": []}
    url, headers, body, seconds = sent[0]
    assert seconds == 180 and "secret" not in url and any("secret" in v for v in headers.values()) and "the prompt" in json.dumps(body) and "m1" in url + json.dumps(body)
    failing = lambda status, text: models.client(lambda *_: (status, text), provider, key="k", env={})
    with pytest.raises(RuntimeError, match="extraction failed: HTTP 429 slow down"):
        failing(429, b"slow down")("p", {})
    bad = json.loads(json.dumps(reply).replace("[]", "["))
    with pytest.raises(RuntimeError, match="malformed JSON"):
        failing(200, json.dumps(bad).encode())("p", {})


def test_provider_settings():
    assert models.provider_name("", {}) == "openai" and models.provider_name(" Gemini ", {}) == "gemini" and models.model_name("gemini", "", {}) and models.time_limit({"LLM_REQUEST_TIMEOUT": "7"}) == 7
    for wrong in (lambda: models.provider_name("other", {}), lambda: models.client(models.http_post, "openai", env={}), lambda: models.PROVIDERS["gemini"].text({"candidates": []}), lambda: models.PROVIDERS["gemini"].text({"candidates": [{"content": None}]})):
        with pytest.raises(RuntimeError):
            wrong()


def test_search_runs_on_executors(table):
    rows = table(["search_query"], {"search_query": "a"}, {"search_query": "a"}, {"search_query": "b"})
    got = fetch.searched(rows, lambda q: [{"link": f"{q}{k}", "title": None} for k in range(2 if q == "a" else 0)]).collect()
    assert sorted((r["search_query"], r["rank"], r["link"]) for r in got) == [("a", 1, "a0"), ("a", 2, "a1")]


def test_optional_json(tmp_path):
    (tmp_path / "bad").write_text("{")
    (tmp_path / "good").write_text('{"a": 1}')
    assert [sinks.optional_json(str(tmp_path / n)) for n in ("none", "bad", "good")] == [{}, {}, {"a": 1}]


def test_answer_forms():
    assert llm_facts.grouped({"facts": [{"fact_type": "Tuition"}]})["tuition_facts"] and llm_facts.grouped([{"cert_requirement_facts": [{"cert": "SAT"}]}])["cert_requirement_facts"]
    assert [llm_facts.route(x) for x in ({"test": "IELTS"}, {"scholarship_available": False}, {"portfolio_required": False}, {"rolling_admission": True}, {})] == ["english_requirement_facts", "scholarship_facts", "", "application_facts", ""]


# files and verbs


def test_html_text():
    assert html.plain_text(b"<html><title>T &amp; x</title><script>no</script><p>A&nbsp;b</p></html>", "text/html") == ("T & x A b", "T & x")


def test_crawl(table, tmp_path):
    (tmp_path / "p.html").write_text("<html><title>Fees</title><script>hidden()</script><p>Tuition fees</p></html>")
    rows = table(sc.SOURCE, source("a", url=f"file://{tmp_path}/p.html"), source("b", url="file:///nowhere.html"), source("c", crawl_method="manual"), source("d", crawl_method="playwright"), source("e", url="https://no.net"))
    got = {r["evidence"]["source_id"]: r for r in fetch.crawl(rows, NOW).collect()}
    assert [(got[k]["source"]["status"], got[k]["evidence"]["status"]) for k in "abcde"] == [("fetched", "ok"), ("failed", "failed"), ("manual", "manual"), ("skipped", "playwright_required"), ("failed", "failed")]
    assert "hidden" not in got["a"]["evidence"]["extracted_text"] and got["a"]["evidence"]["title"] == "Fees"


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    sinks.write_csv(spark.createDataFrame([("é, \"q\"", ["b", "a"], True, None)], "a string, b array<string>, c boolean, d string"), path, ["a", "b", "c", "d", "e"])
    raw = open(path, "rb").read()
    assert raw[:3] == b"\xef\xbb\xbf" and list(csv.reader(raw.decode("utf-8-sig").splitlines()))[1] == ['é, "q"', '["b", "a"]', "true", "", ""]
    assert tables.read_csv(spark, path).first()["a"] == 'é, "q"'


def test_pilot_run(spark, tmp_path):
    (tmp_path / "page.html").write_text("<html><body>" + "Tuition fee for international student is USD 20,000. " * 20 + "</body></html>")
    write = lambda name, columns, rows: (tmp_path / name).write_text("\n".join([",".join(columns), *[",".join(r.get(c, "") for c in columns) for r in rows]]) + "\n")
    write("seed.csv", sc.SEED, [SEED])
    write("sources.csv", sc.SOURCE, [source(url=f"file://{tmp_path}/page.html", source_id="")])
    write("rankings.csv", sc.RANKING_IMPORT, [{"university_id": "u", "qs_rank": "3"}])
    out = tmp_path / "out"
    assert cli.main(["run-pilot", "--seed", f"{tmp_path}/seed.csv", "--sources", f"{tmp_path}/sources.csv", "--rankings", f"{tmp_path}/rankings.csv", "--out-dir", str(out)], spark=spark) == 0
    manifest = json.loads((out / "run_manifest.json").read_text())
    assert manifest["row_counts"]["product_profiles"] == 1 and manifest["input_files"]["sources"] == f"{tmp_path}/sources.csv" and manifest["run_id"].startswith("pilot_") and "facts_llm" in manifest["output_files"]
    assert manifest["row_counts"]["university_product_profiles"] == 1 and manifest["row_counts"]["facts"] > 0 and len(manifest["quality_gate_summary"]) == 4
    profile = tables.read_csv(spark, str(out / "university_product_profiles.csv")).first()
    assert (profile["tuition_usd_min"], profile["qs_rank"]) == ("20000", "3")


def test_stream(spark, table, tmp_path):
    from provena import streaming

    table(sc.EVIDENCE, evidence(text="Tuition fee for international student is USD 20,000. " * 20)).drop(sc.ORDER).write.parquet(f"{tmp_path}/in")
    streaming.facts_stream(streaming.read_evidence(spark, f"{tmp_path}/in"), table(sc.SOURCE, source()), f"{tmp_path}/out", f"{tmp_path}/ck", NOW).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").filter("fact_type = 'tuition'").count() > 0


def test_name_normalize_reads_the_whole_text(spark, tmp_path):
    from provena.plans import driver

    text = " ".join(f"Café word{k} (x{k}) at" for k in range(200))
    spark.createDataFrame([(1, text, "s1")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = driver.name_normalize(spark, str(tmp_path)).first()
    assert got["norm"] == " ".join(f"cafe word{k} at" for k in range(200)) + " and of the s1"
    assert got["simple"] == " ".join(f"cafe word{k}" for k in range(200)) + " s1"


# reading and writing CSV


ODD_CSV = [
    'a,b,c\r\n1,"x\r\ny",3\r\n',
    '﻿"a\nb",b,c\n"line\n1\n\n\n2","q""uo""te",z\n',
    'a,b\n5" pipe,6\n"abc"def,"g\n"h\n,"\n"\n"",""\n"open until\n\nthe end',
    'a,b\n' + "".join(f'{k},"{"multi" * (k % 40)}\n{k}, ""{k}"""\n' for k in range(120)),
    'a,b\n"' + "\n".join(f'piece "" {k}' for k in range(300)) + '",last\nx,y',
    "a,b\n\n\n1,2\n\n", "a,b", "", '"', "a,b\n1\n1,2,3,4\n", 'a,b\rlone,"re\rturn"\n1,2\n', 'a\tb\n"x\ty"\t"2\n3"\n',
]


@pytest.mark.parametrize("k", range(len(ODD_CSV)))
def test_ranges_of_a_file_read_as_one(spark, tmp_path, k):
    """Files cut into ranges of a few bytes hold the records that one reader finds, in its order."""
    path, text = tmp_path / "t.csv", ODD_CSV[k]
    path.write_bytes(text.encode())
    separator = "\t" if "\t" in text else ","
    want = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter=separator) if r]
    saved = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (1 << 20, 150, 33, 7) if len(text) < 900 else (1 << 20, 600, 150):
            for c in saved:
                spark.conf.set(c, size)
            found = split_csv.records(spark, str(path), separator)
            rows = sorted(found.collect(), key=lambda r: r[sc.ORDER])
            assert [r["cells"] for r in rows] == want, size
            assert [r["first"] for r in rows] == [n == 0 for n in range(len(want))]
            if want:
                assert split_csv.first_record(spark, str(path), separator, 1) == want[0]
            if len(text) > 900 and size == 150:
                assert split_csv.lines_of(spark, str(path)).rdd.getNumPartitions() > 10
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)


def test_files_of_a_folder(spark, tmp_path):
    for name, rows in (("b", 'k,v\n3,"x\ny"\n'), ("a", "﻿k,v\n1,\n2,z\n , \n")):
        (tmp_path / f"{name}.csv").write_text(rows, encoding="utf-8")
    got = tables.read_csv(spark, str(tmp_path))
    assert [(r["k"], r["v"]) for r in got.orderBy(sc.ORDER).collect()] == [("1", ""), ("2", "z"), ("3", "x\ny")]
    assert tables.read_csv(spark, str(tmp_path / "a.csv")).columns == ["k", "v", sc.ORDER]
    with pytest.raises(Exception, match="(?i)path"):
        tables.read_csv(spark, str(tmp_path / "none.csv"))


def test_csv_file_is_written_by_tasks_in_order(spark, tmp_path):
    path = tmp_path / "deep" / "t.csv"
    rows = [(k, f"ñ {k}, \"q\"\n", None if k % 3 else [k], k % 2 == 0) for k in range(500)]
    df = spark.createDataFrame(rows, "k long, s string, l array<long>, b boolean").repartition(7).orderBy("k")
    assert sinks.write_csv(df, str(path), ["s", "absent", "k", "l", "b"]) == 500
    raw = path.read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfs,absent,k,l,b\r\n")
    got = list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline="")))
    assert got[1:] == [[s, "", str(k), "" if l is None else f"[{k}]", str(b).lower()] for k, s, l, b in rows]
    assert sinks.write_csv(df.limit(0), str(path), ["k"]) == 0 and path.read_text(encoding="utf-8-sig") == "k\n"
    assert sinks.write_csv(df, str(path), ["absent"]) == 500
    assert [p.name for p in path.parent.iterdir()] == ["t.csv"]


def test_failed_tasks_leave_the_old_file(spark, tmp_path):
    path = tmp_path / "t.csv"
    good = spark.range(100).selectExpr("CAST(id AS STRING) AS k")
    sinks.write_csv(good.repartition(3), str(path), ["k"])
    old = path.read_bytes()
    bad = spark.range(0, 100, 1, 4).selectExpr("IF(id = 99, CAST(raise_error('no') AS STRING), CAST(id AS STRING)) AS k")
    with pytest.raises(Exception, match="no"):
        sinks.write_csv(bad, str(path), ["k"])
    assert path.read_bytes() == old and [p.name for p in tmp_path.iterdir()] == ["t.csv"]
    # a part that was lost before the commit
    writer = csv_file.CsvFileWriter(str(path), ["k"], ["k"])
    writer.parts.mkdir()
    (writer.parts / "0-x").write_bytes(b"1\r\n")
    with pytest.raises(OSError, match="of 9 bytes"):
        writer.commit([csv_file.Part(0, str(writer.parts / "0-x"), 3, 9), None])
    assert path.read_bytes() == old and [p.name for p in tmp_path.iterdir()] == ["t.csv"]
    # a table over its own source
    rows = tables.read_csv(spark, str(path))
    assert sinks.write_csv(rows.filter("k < 50").orderBy(sc.ORDER), str(path), ["k"]) == tables.read_csv(spark, str(path)).count() > 0


# incremental merging


def crawl(rng, keys):
    return [evidence(rng.choice(keys), rng.choice("abc"), status=rng.choice(["ok", "failed", "empty", "odd", ""]), title=str(n)) for n in range(rng.randint(0, 25))]


def test_batches_merge_as_if_applied_one_by_one(table, spark, tmp_path):
    from provena import streaming

    rng = random.Random(2)
    keys = [f"s{k}" for k in range(12)]
    first = table(sc.EVIDENCE, *[evidence(k, "base", status=rng.choice(["ok", "failed", ""])) for k in [*keys, "s1", "s2"]])
    held = streaming.evidence_table(spark, str(tmp_path / "t"), 4)
    held.create(first)
    held.create(first.limit(0))
    shown = lambda df: sorted((tuple(r[c] for c in (sc.ORDER, *sc.EVIDENCE)) for r in df.collect()), key=str)
    want = first
    for n in range(7):
        batch = table(sc.EVIDENCE, *crawl(rng, keys))
        want = source_map.merge_evidence(want, batch).drop("replaced")
        assert held.append(batch, n) and not held.append(table(sc.EVIDENCE, *crawl(rng, keys)), n)
        if n in (2, 4, 5):
            before = shown(held.read())
            assert held.compact(0.0 if n == 4 else 0.3) is not None and shown(held.read()) == before
        assert shown(held.read()) == shown(want), n
    assert max(held.bases().values()) >= 4 and min(held.batches()) > 0


def test_a_batch_writes_its_own_rows_only(table, spark, tmp_path):
    """What a batch writes follows its size, a batch that was cut off is written anew, and a stream ends where a merge does."""
    from provena import streaming

    held = streaming.evidence_table(spark, str(tmp_path / "t"), 4)
    rows = [evidence(f"s{k}", "x" * 50, status="failed") for k in range(400)]
    held.create(table(sc.EVIDENCE, *rows))
    size = lambda path: sum(f.stat().st_size for f in path.rglob("*.parquet"))
    base = size(tmp_path / "t" / "base")
    again = table(sc.EVIDENCE, evidence("s7", "new"), evidence("s8", "no", status="odd"), evidence("none", "new"))
    (tmp_path / "t" / "delta" / "batch=0" / "bucket=1").mkdir(parents=True)
    assert held.batches() == []
    again.drop(sc.ORDER).coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        streaming.merge_stream(streaming.read_evidence(spark, str(tmp_path / "in")), held, str(tmp_path / "ck")).awaitTermination()
    assert held.batches() == [0] and size(tmp_path / "t" / "base") == base and size(tmp_path / "t" / "delta") < base
    assert spark.read.parquet(str(tmp_path / "t" / "delta")).count() == 2
    got = held.read()
    assert got.count() == 400 and [r["source_id"] for r in got.filter("extracted_text = 'new'").collect()] == ["s7"]


def test_nth_row_by_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 5, 1 << 40, 1 << 59, rng.randint(0, 1 << 50)]), rng.randint(-3, 3), k) for k in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, k long").selectExpr("struct(a, struct(b, k) AS more) AS o", "a").repartition(5).persist()
    for n in (1, 2, 150, 299, 300, 999):
        got = spark.range(1).select(order_stats.nth(df, "o", n).alias("o"), order_stats.nth(df, "a", n).alias("a")).first()
        want = sorted(rows)[min(n, 300) - 1]
        assert ((got["o"]["a"], got["o"]["more"]["b"], got["o"]["more"]["k"]), got["a"]) == (want, sorted(r[0] for r in rows)[min(n, 300) - 1])
    assert order_stats.nth(df.limit(0), "a", 1) is None


@pytest.mark.parametrize(("limit", "offset"), [(3, 0), (0, 4), (3, 4), (100, 2), (1, 100), (0, 0)])
def test_offset_and_limit_at_any_place(table, limit, offset):
    sources = table(sc.SOURCE, source("a"), source("b", "career"))
    rows = [evidence(k, str(n), status="failed" if n % 5 == 4 else "ok") for n, k in enumerate("aabaaabaaaabbaa")]
    planned = llm_facts.plan(sources, table(sc.EVIDENCE, *rows), limit, offset, ["tuition_fees"])
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "TakeOrdered" not in plan
    sent, want = 0, []
    for r in rows:
        why = "source type filtered" if r["source_id"] == "b" else "non-usable evidence" if r["status"] == "failed" else ""
        if not why:
            sent += 1
            why = "llm offset skipped" if sent <= offset else "llm limit reached" if limit and sent > offset + limit else ""
        want.append(why)
    assert [r["skip"] for r in planned.orderBy(sc.ORDER).collect()] == want


def test_bare_forms_of_all_characters(spark):
    import sys
    import unicodedata

    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rows = ["".join(chars[k : k + 64]) for k in range(0, len(chars), 64)] + ["ﬁne Ⅷ ½ ㌔ 한글 각 ＡＢＣ é ﷺ", ""]
    got = spark.createDataFrame([(r,) for r in rows], "t string").repartition(8).select("t", fn.strip_accents(F.col("t")).alias("s")).collect()
    assert all(r["s"] == "".join(c for c in unicodedata.normalize("NFKD", r["t"]) if not unicodedata.combining(c)) for r in got)
    assert one(spark, fn.normalize_name(F.lit("Ｕniversité ﬁnance № 7 (ﬀ)"))) == "universite finance no 7"
    assert one(spark, fn.strip_accents(F.lit(None).cast("string"))) is None


def test_addresses_resolve_as_urljoin_does(spark):
    from urllib.parse import urljoin

    from provena.functions import urls

    rng = random.Random(1)
    piece = lambda: rng.choice(["a", "b.html", "..", ".", "", "c;p", "..;q", ";", "é", "%2e", "x y", "...", "a:b"])
    path = lambda: rng.choice(["", "/"]) + "/".join(piece() for _ in range(rng.randint(0, 5)))
    tail = lambda: rng.choice(["", "?", "?q=1/../2", "?a?b"]) + rng.choice(["", "#", "#f?x", "#a#b"])

    def url():
        scheme = rng.choice(["http:", "HTTPS:", "ftp:", "mailto:", "file:", "", "", "", "javascript:", "tel:", "weird+x:", "1x:"])
        return rng.choice(["", " ", "\n\t"]) + scheme + rng.choice(["//h.org", "//u@h.org:80", "//[::1]:8", "//[zz", "//", "", "", "", "//é.org", "//h℀.org"]) + path() + tail()

    rfc = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g?y/./x", "g#s/../x", "http:g"]
    rows = [(url(), url() if rng.random() < 0.5 else path() + tail()) for _ in range(1500)] + [("http://a/b/c/d;p?q", x) for x in rfc] + [(None, "x"), ("http://a/", None), ("", "x")]

    def wanted(base, link):
        try:
            return None if base is None or link is None else urljoin(base, link)
        except ValueError:
            return link

    got = spark.createDataFrame(rows, "b string, l string").select("b", "l", urls.resolve(F.col("b"), F.col("l")).alias("r")).collect()
    assert [r for r in got if r["r"] != wanted(r["b"], r["l"])] == []

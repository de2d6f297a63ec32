"""The pipeline's verbs: read tables, apply transforms, write exports.

python -m provena.cli VERB --help lists a verb's options.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from datetime import date, datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provena import schemas as sc
from provena import sinks
from provena.operators import discovery, extract, llm_facts, profiles, quality, rankings, source_map
from provena.materialize import counted, removed
from provena.sources import fetch as crawling
from provena.sources import models, tables

#: Outputs that the pipeline's manifest lists, by name.
PIPELINE_OUTPUTS = {
    **{k: f"{k}.csv" for k in ("sources", "evidence", "facts", "facts_extracted", "facts_generated", "facts_llm", "llm_extraction_report", "programs", "qa_report", "batch_qa_report", "field_gap_report")},
    "product_profiles": "university_product_profiles.csv", "import": "universities_import.csv", "matching_tags": "university_matching_tags.csv", "writer_context": "university_writer_context.csv", "quality_gate": "pilot_quality_gate.csv",
}
#: Fewer ranking records than this from plain pages, and a browser is asked too.
FEW_RECORDS = 100
#: verb: options (name, default); None: required.
VERBS: dict[str, dict[str, object]] = {
    "validate-sources": {"seed": None, "sources": None},
    "crawl-sources": {"sources": None, "out-dir": None, "timeout": 25},
    "extract-facts": {"sources": None, "evidence": None, "out-dir": None},
    "build-profiles": {"seed": None, "sources": None, "facts": None, "rankings": None, "out-dir": None, "country-costs": "", "evidence": "", "run-id": ""},
    "run-pilot": {"seed": None, "sources": None, "rankings": None, "out-dir": None, "timeout": 25, "country-costs": "", "run-id": ""},
    "discover-sources": {"seed": None, "out": None},
    "suggest-sources": {"sources": None, "out": None, "timeout": 25},
    "build-source-map-candidates": {"sources": None, "suggestions": None, "out": None, "per-type-limit": 1},
    "normalize-source-map": {"seed": None, "sources": None, "out": None},
    "build-retry-source-map": {"sources": None, "out": None, "source-types": ""},
    "merge-crawl-outputs": {"base-sources": None, "base-evidence": None, "retry-sources": None, "retry-evidence": None, "out-dir": None},
    "apply-source-repairs": {"seed": None, "base-sources": None, "repairs": None, "out": None},
    "classify-evidence": {"sources": None, "evidence": None, "out": None},
    "search-sources": {"seed": None, "existing-sources": None, "out": None, "source-types": None, "per-type-limit": 3},
    "promote-search-sources": {"seed": None, "base-sources": None, "candidates": None, "out": None},
    "extract-facts-llm": {"sources": None, "evidence": None, "out-dir": None, "run-id": "", "provider": "", "model": "", "limit": 0, "offset": 0, "sleep-seconds": 0.0, "source-types": ""},
    "fetch-qs-rankings": {"out-dir": None, "no-playwright": False},
    "normalize-qs-rankings": {"input": None, "out-dir": None},
    "match-rankings": {"seed": None, "qs": None, "base": None, "out": None, "report": None},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    verbs = top.add_subparsers(dest="verb", required=True)
    for verb, options in VERBS.items():
        own = verbs.add_parser(verb)
        for name, default in options.items():
            if default is False:
                own.add_argument(f"--{name}", action="store_true")
            elif default is None:
                own.add_argument(f"--{name}", required=True)
            else:
                own.add_argument(f"--{name}", default=default, type=type(default))
    return top


def split_set(text: str) -> list[str] | None:
    return [x.strip() for x in text.split(",") if x.strip()] or None


def load_env(path: str = ".env") -> None:
    """KEY=value lines of a file, without overriding what is set."""
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            key, sign, value = line.strip().partition("=")
            if sign and key and not key.startswith("#"):
                os.environ.setdefault(key.strip(), value.strip().strip("\"'"))


class Clients:
    """What reaches outside; tests and deployments set their own."""

    def __init__(
        self, fetch: crawling.Fetcher | None = None, search: Callable[[str], list[dict]] | None = None, model: llm_facts.Client | None = None, browser: crawling.Fetcher | None = None,
        transport: models.Transport | None = None, capture: Callable[[str, int], tuple[str, list]] | None = None,
    ):
        """transport carries requests to model providers; capture(url, seconds) gives a page as a browser shows it and the JSON values that it loaded."""
        self.fetch, self.search, self.model, self.browser = fetch or crawling.open_file, search, model, browser
        self.transport, self.capture = transport, capture


class Run:
    def __init__(self, spark: SparkSession, args: argparse.Namespace, clients: Clients):
        self.spark, self.a, self.clients = spark, args, clients
        self.now = datetime.now(timezone.utc).replace(microsecond=0).isoformat()
        self.counts: dict[str, int] = {}
        self.outputs: dict[str, str] = {}
        self.tables: list[DataFrame] = []

    def read(self, path: str) -> DataFrame:
        return tables.read_csv(self.spark, path)

    def write(self, df: DataFrame, path: str, columns: list[str]) -> None:
        self.counts[Path(path).stem] = sinks.write_csv(df, path, columns)
        self.outputs[Path(path).stem] = path

    def held(self, df: DataFrame, **counts: Column) -> DataFrame:
        """df written once for several outputs, and counted on the way (self.seen); its files go when the verb is done."""
        done, self.seen = counted(df, **counts)
        self.tables.append(done)
        return done

    def done(self) -> None:
        removed(*self.tables)
        self.tables = []

    def out(self, name: str) -> str:
        return f"{self.a.out_dir}/{name}"

    # verbs
    def validate_sources(self) -> int:
        seed, sources = self.read(self.a.seed), self.read(self.a.sources)
        errors = source_map.validate_seed(seed).withColumn("side", F.lit(0)).unionByName(source_map.validate_sources(sources, seed).withColumn("side", F.lit(1)))
        found = [r["message"] for r in errors.orderBy("side", "row_number", "check").toLocalIterator()]
        print("\n".join(found) if found else "valid")
        return int(bool(found))

    def crawl_sources(self) -> int:
        done = self.held(crawling.crawl(self.read(self.a.sources), self.now, self.clients.fetch, self.a.timeout, self.clients.browser))
        self.write(done.select("source.*").orderBy(sc.ORDER), self.out("sources.csv"), sc.SOURCE)
        self.write(done.select("evidence.*").orderBy(sc.ORDER), self.out("evidence.csv"), sc.EVIDENCE)
        return 0

    def extract_facts(self) -> int:
        sources, evidence = self.held(self.read(self.a.sources)), self.held(self.read(self.a.evidence))
        facts = self.held(extract.facts(sources, evidence, self.now))
        for name, rows in (("facts", facts), ("facts_extracted", extract.extracted(facts)), ("facts_generated", extract.generated(facts))):
            self.write(extract.in_order(rows), self.out(f"{name}.csv"), sc.FACT)
        self.write(extract.programs(sources, evidence).orderBy("university_id", "name", sc.ORDER), self.out("programs.csv"), sc.PROGRAM)
        return 0

    def build_profiles(self) -> int:
        a = self.a
        facts, evidence = self.held(self.read(a.facts)), self.read(a.evidence) if a.evidence else tables.read_optional(self.spark, "", sc.EVIDENCE)
        costs = tables.read_optional(self.spark, a.country_costs, sc.COUNTRY_COST)
        built = self.held(profiles.build(self.read(a.seed), self.read(a.sources), facts, self.read(a.rankings), costs, evidence)).orderBy("university_id")
        for name, rows, columns in (
            ("university_product_profiles", profiles.products(built), sc.PRODUCT), ("university_matching_tags", profiles.matching_tags(built), sc.MATCHING), ("university_writer_context", profiles.writer_contexts(built), sc.WRITER),
            ("universities_import", profiles.products(built), sc.PRODUCT), ("qa_report", profiles.qa_report(built), sc.QA), ("batch_qa_report", profiles.batch_qa(built), sc.BATCH_QA), ("field_gap_report", profiles.field_gaps(built), sc.GAP),
        ):
            self.write(rows, self.out(f"{name}.csv"), columns)
        gate = self.held(profiles.quality_gate(built, facts).coalesce(1))
        self.write(gate, self.out("pilot_quality_gate.csv"), sc.GATE)
        inputs = {k: getattr(a, k) for k in ("seed", "sources", "facts", "rankings", "country_costs", "evidence") if getattr(a, k)}
        self.gate = [r.asDict() for r in gate.collect()]  # four rows
        sinks.write_manifest(a.out_dir, a.run_id or sinks.run_id(), inputs, self.outputs, self.counts, self.gate, sinks.optional_json(self.out("llm_metadata.json")))
        return 0

    def run_pilot(self) -> int:
        if self.validate_sources():
            return 1
        a = self.a
        self.crawl_sources()
        given = a.sources
        a.sources, a.evidence, a.facts = self.out("sources.csv"), self.out("evidence.csv"), self.out("facts.csv")
        self.extract_facts()
        self.build_profiles()
        inputs = {k: getattr(a, k) for k in ("seed", "sources", "rankings", "country_costs")} | {"sources": given}
        outputs = {k: self.out(name) for k, name in PIPELINE_OUTPUTS.items()}
        counts = self.counts | {k: self.counts[Path(p).stem] for k, p in outputs.items() if Path(p).stem in self.counts}
        sinks.write_manifest(a.out_dir, a.run_id or sinks.run_id("pilot"), inputs, self.outputs | outputs, counts, self.gate, sinks.optional_json(self.out("llm_metadata.json")))
        return 0

    def discover_sources(self) -> int:
        self.write(source_map.starter(self.read(self.a.seed)).orderBy(sc.ORDER), self.a.out, sc.SOURCE)
        return 0

    def suggest_sources(self) -> int:
        pages = crawling.homepages(self.read(self.a.sources), self.clients.fetch, self.a.timeout)
        links = discovery.links(pages).withColumn(sc.ORDER, F.struct(sc.ORDER, "_place"))
        self.write(discovery.in_order(discovery.suggestions(links)), self.a.out, sc.SUGGESTION)
        return 0

    def build_source_map_candidates(self) -> int:
        found = discovery.candidate_map(self.read(self.a.sources), self.read(self.a.suggestions), self.a.per_type_limit)
        self.write(source_map.in_order(found), self.a.out, sc.SOURCE)
        return 0

    def normalize_source_map(self) -> int:
        if Path(self.a.sources).resolve() == Path(self.a.out).resolve():
            sinks.back_up(self.a.out)
        judged = self.held(source_map.judged_sources(self.read(self.a.sources)), **source_map.normalize_counts())
        self.write(source_map.in_order(source_map.filled(self.read(self.a.seed), judged)), self.a.out, sc.SOURCE)
        print(json.dumps(self.seen, sort_keys=True))
        return 0

    def build_retry_source_map(self) -> int:
        found = source_map.retry_map(self.read(self.a.sources), source_types=split_set(self.a.source_types))
        self.write(found.orderBy("university_id", "source_type", "url", sc.ORDER), self.a.out, sc.SOURCE)
        return 0

    def merge_crawl_outputs(self) -> int:
        a = self.a
        self.write(source_map.merge_sources(self.read(a.base_sources), self.read(a.retry_sources)).orderBy(sc.ORDER), self.out("sources.csv"), sc.SOURCE)
        self.write(source_map.merge_evidence(self.read(a.base_evidence), self.read(a.retry_evidence)).orderBy(sc.ORDER), self.out("evidence.csv"), sc.EVIDENCE)
        return 0

    def apply_source_repairs(self) -> int:
        a = self.a
        changes = {"kept": "", "updated": "updated", "added": "added"}
        done = self.held(source_map.apply_repairs(self.read(a.seed), self.read(a.base_sources), self.read(a.repairs)), **{k: F.count_if(F.col("change") == c) for k, c in changes.items()})
        print(json.dumps({k: n for k, n in self.seen.items() if n}, sort_keys=True))
        self.write(source_map.in_order(done), a.out, sc.SOURCE)
        return 0

    def classify_evidence(self) -> int:
        self.write(quality.classify_evidence(self.read(self.a.sources), self.read(self.a.evidence)).orderBy(sc.ORDER), self.a.out, sc.EVIDENCE)
        return 0

    def search_sources(self) -> int:
        if self.clients.search is None:
            raise RuntimeError("search-sources needs a search client")
        requests = source_map.search_requests(self.read(self.a.seed), self.read(self.a.existing_sources), split_set(self.a.source_types) or [])
        results = self.held(crawling.searched(requests, self.clients.search))
        self.write(source_map.search_candidates(requests, results, self.a.per_type_limit).orderBy("university_id", "source_type", F.col("rank").cast("int")), self.a.out, sc.SEARCH)
        return 0

    def promote_search_sources(self) -> int:
        a = self.a
        self.write(source_map.in_order(source_map.promote(self.read(a.seed), self.read(a.base_sources), self.read(a.candidates))), a.out, sc.SOURCE)
        return 0

    def extract_facts_llm(self) -> int:
        a = self.a
        client = self.clients.model
        if client is None:
            if self.clients.transport is None:
                raise RuntimeError("extract-facts-llm needs a model client or a transport")
            a.provider = models.provider_name(a.provider)
            a.model = models.model_name(a.provider, a.model)
            client = models.client(self.clients.transport, a.provider, a.model)
        planned = llm_facts.plan(self.read(a.sources), self.read(a.evidence), a.limit, a.offset, split_set(a.source_types))
        answered = self.held(llm_facts.ask(planned, client, a.sleep_seconds), rows=F.count(F.lit(1)))
        rows_seen = self.seen["rows"]
        made = self.held(llm_facts.facts(answered, self.now), rows=F.count(F.lit(1)))
        made_rows = self.seen["rows"]
        old = self.read(self.out("facts.csv")) if Path(self.out("facts.csv")).exists() else tables.read_optional(self.spark, "", sc.FACT)
        merged = self.held(extract.merge(old, made))
        for name, rows in (("facts_llm", extract.from_model(merged)), ("facts", merged), ("facts_extracted", extract.extracted(merged)), ("facts_generated", extract.generated(merged))):
            self.write(extract.in_order(rows), self.out(f"{name}.csv"), sc.FACT)
        self.write(llm_facts.report(answered, made, a.model).orderBy(sc.ORDER), self.out("llm_extraction_report.csv"), sc.LLM_REPORT)
        Path(self.out("llm_metadata.json")).write_text(json.dumps({"run_id": a.run_id, "provider": a.provider, "model": a.model, "facts_llm": made_rows, "evidence_rows_seen": rows_seen}, indent=2, sort_keys=True) + "\n")
        return 0

    def _ranked(self, raw: DataFrame) -> None:
        raw = self.held(raw)
        self.write(raw.orderBy(sc.ORDER), self.out("qs_raw.csv"), sc.RANKING_RAW)
        best = rankings.best_ranks(rankings.normalize(raw, date.today().isoformat()))
        self.write(best.orderBy(rankings.or_large(F.col("rank_numeric")), sc.ORDER), self.out("qs_normalized.csv"), sc.RANKING_NORMALIZED)

    def fetch_qs_rankings(self) -> int:
        """Ranking records of the official addresses; answers and failures are kept beside the tables. With few records, those that a browser captures are added."""
        from provena.lexicons import RANKING_PROVIDER, RANKING_URL, RANKING_URLS, RANKING_YEAR

        def keep(name: str, content: str) -> None:
            Path(self.out(name)).parent.mkdir(parents=True, exist_ok=True)
            Path(self.out(name)).write_text(content, encoding="utf-8")

        def mined() -> DataFrame:
            return rankings.records(self.spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], f"{sc.ORDER} long, body string"))

        bodies, refused = [], []
        for k, url in enumerate(RANKING_URLS, 1):
            try:
                bodies.append(self.clients.fetch(url, 60)[0].decode("utf-8", "replace"))
                keep(f"qs_official_response_{k}.txt", bodies[-1])
            except Exception as failure:  # noqa: BLE001  an address that doesn't answer leaves the others
                refused.append(f"{url}\nQS static fetch failed: {failure}")
        if refused:
            keep("fetch_qs_static_error.txt", "\n\n".join(refused))
        if not self.a.no_playwright and mined().count() < FEW_RECORDS:
            try:
                if self.clients.capture is None:
                    raise RuntimeError(crawling.BROWSER_NOTE)
                page, values = self.clients.capture(RANKING_URL, 90)
                keep("qs_playwright_page.html", page)
                keep("qs_playwright_payloads.json", json.dumps(values, ensure_ascii=False, indent=2) + "\n")
                bodies.append(json.dumps(values))
            except Exception as failure:  # noqa: BLE001  the records found so far are kept
                keep("fetch_qs_playwright_error.txt", str(failure))
        found = mined().withColumns({"ranking_provider": F.lit(RANKING_PROVIDER), "ranking_year": F.lit(RANKING_YEAR), "source_url": F.lit(RANKING_URL), "retrieved_at": F.lit(date.today().isoformat())})
        self._ranked(found)
        return 0

    def normalize_qs_rankings(self) -> int:
        self._ranked(tables.ranking_rows(tables.read_rankings(self.spark, self.a.input), self.a.input, date.today().isoformat()))
        return 0

    def match_rankings(self) -> int:
        a = self.a
        seed = self.read(a.seed)
        found = self.held(rankings.candidates(seed, self.read(a.qs)))
        imports, report = rankings.match(seed, found, self.read(a.base))
        self.write(imports.orderBy("university_id"), a.out, sc.RANKING_IMPORT)
        self.write(report.orderBy("university_id"), a.report, sc.MATCH_REPORT)
        self.write(rankings.candidate_rows(found).orderBy("university_id", F.desc("confidence_score"), "place"), str(Path(a.report).with_name("ranking_match_candidates.csv")), sc.MATCH_CANDIDATE)
        return 0


def main(argv: list[str] | None = None, clients: Clients | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    load_env()
    session = spark or SparkSession.builder.appName("provena").getOrCreate()
    run = Run(session, args, clients or Clients())
    try:
        return getattr(run, args.verb.replace("-", "_"))()
    finally:
        run.done()


if __name__ == "__main__":
    sys.exit(main())

"""Crawling: sources to evidence through an injected fetcher; failures become rows."""

from __future__ import annotations

import hashlib
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena import functions as fn
from provena.operators.quality import classify
from provena.schemas import EVIDENCE, ORDER, SOURCE, conform, either, ordered

Fetcher = Callable[[str, int], tuple[bytes, str]]
PARSER_VERSION = "provena/0.1"
PDF_NOTE = "PDF downloaded but text extraction requires an optional PDF parser"
BROWSER_NOTE = "playwright package is not installed; run `pip install playwright` and `python -m playwright install chromium`"


def content_type(name: str) -> str:
    low = name.lower()
    if low.endswith((".html", ".htm")):
        return "text/html; charset=utf-8"
    return "application/pdf" if low.endswith(".pdf") else "text/plain; charset=utf-8"


def open_file(url: str, timeout: int) -> tuple[bytes, str]:
    """The default fetcher: file: addresses only, nothing leaves the machine."""
    parts = urllib.parse.urlparse(url)
    if parts.scheme != "file":
        raise ValueError(f"no network client is set for {url}")
    path = urllib.request.url2pathname(parts.path)
    with open(path, "rb") as handle:
        return handle.read(), content_type(path)


def http_client(headers: dict[str, str] | None = None) -> Fetcher:
    """A fetcher for http(s) and file addresses. Certificates are always verified."""

    def fetch(url: str, timeout: int) -> tuple[bytes, str]:
        if url.startswith("file:"):
            return open_file(url, timeout)
        request = urllib.request.Request(url, headers=headers or {"User-Agent": PARSER_VERSION, "Accept-Encoding": "identity"})
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.read(), response.headers.get("content-type", "")

    return fetch


def crawl(sources: DataFrame, run_ts: str, fetch: Fetcher = open_file, timeout: int = 25, browser: Fetcher | None = None) -> DataFrame:
    """One row for each source: struct `source` and struct `evidence`. Project both from one cached or written frame."""
    from provena.sources.html import plain_text

    rows = conform(ordered(sources), SOURCE)
    rows = rows.withColumns({"source_id": either("source_id", fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("url"))), "crawl_method": either("crawl_method", F.lit("static")), "priority": either("priority", F.lit("1"))})
    rows = rows.withColumn("how", F.when(F.col("crawl_method") == "manual", "manual").when(F.col("crawl_method") == "playwright", "browser").when((F.col("crawl_method") == "pdf") | F.lower("url").endswith(".pdf"), "pdf").otherwise("static"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for how, url in zip(batch["how"], batch["url"], strict=True):
                title = body = digest = error = ""
                state = "ok"
                client = browser if how == "browser" else fetch
                if how == "manual":
                    state, error = "manual", "manual source; crawler skipped"
                elif client is None:
                    state, error = "playwright_required", BROWSER_NOTE
                else:
                    try:
                        raw, kind = client(url, timeout)
                        if how == "pdf":
                            state, error, digest = "unsupported_pdf", PDF_NOTE, hashlib.sha256(raw).hexdigest()
                        else:
                            body, title = plain_text(raw, kind)
                            digest = hashlib.sha256(body.encode("utf-8", "replace")).hexdigest() if body else ""
                            state = "ok" if body else "empty"
                    except Exception as failure:  # noqa: BLE001  a failed fetch is a row of evidence
                        state, error = "failed", str(failure)
                got.append((title, body, digest, state, error))
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(got, columns=["title", "extracted_text", "content_hash", "state", "error"])], axis=1)

    schema = ", ".join([*(f"{c} string" for c in SOURCE), f"{ORDER} long", "how string, title string, extracted_text string, content_hash string, state string, error string"])
    done = rows.mapInPandas(run, schema)
    tried = F.col("state").isin("ok", "empty") | (F.col("state") == "failed")
    fetched = F.when(F.col("state") == "ok", "fetched").otherwise("failed")
    # a pdf, a manual row and a missing browser keep the initial failed state without a reason
    done = done.withColumn("fetched", fetched).withColumn("q", classify(F.col("source_type"), F.col("title"), F.col("extracted_text"), F.col("fetched"), F.when(F.col("state") == "failed", F.col("error")).otherwise("")))
    status = F.when(F.col("state").isin("ok", "unsupported_pdf"), "fetched").when(F.col("state") == "manual", "manual").when(F.col("state") == "playwright_required", "skipped").otherwise("failed")
    evidence = {
        "evidence_id": fn.stable_id("ev", F.col("source_id"), F.col("url"), F.lit(run_ts)), "retrieved_at": F.lit(run_ts), "parser_version": F.lit(PARSER_VERSION), "fetch_status": F.col("fetched"),
        "content_quality_status": F.when(tried, F.col("q.status")).otherwise("fetch_failed"), "content_quality_reason": F.when(tried, F.col("q.reason")).otherwise(""), "text_len": F.when(tried, F.length("extracted_text")).otherwise(0).cast("string"),
        "content_signal_score": F.when(tried, fn.two_decimals(F.col("q.score"))).otherwise("0.00"), "status": F.col("state"),
    }
    source = {"status": status, "last_crawled_at": F.when(F.col("state").isin("manual", "playwright_required"), "").otherwise(run_ts)}
    return done.select(F.struct(*[source.get(c, F.col(c)).alias(c) for c in SOURCE], ORDER).alias("source"), F.struct(*[evidence.get(c, F.col(c)).alias(c) for c in EVIDENCE], ORDER).alias("evidence"))


def searched(requests: DataFrame, search: Callable[[str], list[dict]]) -> DataFrame:
    """Results of each distinct search_query, ranked from 1. The calls run on the executors; write the rows before use."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [(q, k, *(str(hit.get(c, "")) for c in ("link", "title", "snippet"))) for q in batch["search_query"] for k, hit in enumerate(search(q), 1)]
            yield pd.DataFrame(hits, columns=["search_query", "rank", "link", "title", "snippet"])

    return requests.select("search_query").distinct().mapInPandas(run, "search_query string, rank int, link string, title string, snippet string")


def homepages(sources: DataFrame, fetch: Fetcher = open_file, timeout: int = 25) -> DataFrame:
    """Homepages of official_home sources: university_id, university_name, url, html. Pages that can't be fetched, and PDF, are left out."""
    from provena.sources.html import decoded

    rows = conform(ordered(sources), SOURCE).filter("source_type = 'official_home'").select("university_id", "university_name", "url", ORDER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bodies = []
            for url in batch["url"]:
                try:
                    raw, kind = fetch(url, timeout)
                    bodies.append(None if "pdf" in kind.lower() else decoded(raw, kind))
                except Exception:  # noqa: BLE001  an unreachable page suggests nothing
                    bodies.append(None)
            out = batch.assign(html=bodies)
            yield out[out["html"].notna()]

    return rows.mapInPandas(run, f"university_id string, university_name string, url string, {ORDER} long, html string")

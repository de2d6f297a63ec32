"""Link discovery: links of homepages, their labels, and the choice of candidate sources."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provena import functions as fn
from provena import lexicons as lx
from provena.functions import urls
from provena.materialize import cut
from provena.schemas import ORDER, SOURCE, SUGGESTION, conform, either, last_wins, ordered, text


def native_links(html: Column) -> Column:
    """(href, anchor text) of the links of a page, by pattern: exact for well-formed anchors with quoted attributes."""
    anchor = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    zipped = F.arrays_zip(F.regexp_extract_all(html, F.lit(anchor), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(anchor), F.lit(2)).alias("inner"))
    found = F.transform(zipped, lambda m: F.struct(m["href"].alias("href"), fn.squeeze(F.regexp_replace(m["inner"], "<[^>]*>", " ")).alias("anchor")))
    return F.filter(found, lambda m: m["href"] != "")


def links(pages: DataFrame, base_col: str = "url", html_col: str = "html") -> DataFrame:
    """Resolved links of pages: the page's columns but the html, then link and anchor, in page order. A parser finds the links; they are resolved natively."""
    from provena.sources.html import page_links

    keep = [c for c in pages.columns if c != html_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in keep), "_place long, link string, anchor_text string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [page_links(h or "") for h in batch[html_col]]
            out = batch.loc[batch.index.repeat([len(f) for f in found]), keep].reset_index(drop=True)
            out["_place"] = [k for f in found for k in range(len(f))]
            out["link"], out["anchor_text"] = [u for f in found for u, _ in f], [a for f in found for _, a in f]
            yield out

    return pages.mapInPandas(run, schema).withColumn("link", urls.resolve(text(base_col), F.col("link")))


def keeps(base: Column, link: Column) -> Column:
    """Whether a link is worth labelling: http(s) with a host, no media file, the base's domain or below (any for a file base)."""
    own, theirs = fn.comparable_domain(fn.url_host(base)), fn.comparable_domain(fn.url_host(link))
    web = link.rlike(r"(?i)^https?://[^/?#]+") & ~fn.url_path(link).rlike(lx.MEDIA_SUFFIX)
    return web & ((fn.url_scheme(base) == "file") | (theirs == own) | theirs.endswith(F.concat(F.lit("."), own)))


def labels(link: Column, anchor: Column) -> Column:
    """(source_type, reason, score) for each label with a hint in the anchor or the url; the first hint counts."""
    words = F.translate(F.lower(F.concat_ws(" ", anchor, link)), "-_", "  ")
    low = F.lower(anchor)
    made = []
    for kind, hints in lx.LINK_HINTS.items():
        hint = F.coalesce(*[F.when(words.contains(h), F.lit(h)) for h in hints])
        made.append(F.when(hint.isNotNull(), F.struct(F.lit(kind).alias("source_type"), F.concat(F.lit("matched keyword '"), hint, F.lit("'")).alias("reason"), F.when(F.contains(low, hint), 0.75).otherwise(0.55).alias("score"))))
    return F.filter(F.array(*made), lambda m: m.isNotNull())


def suggestions(found: DataFrame) -> DataFrame:
    """Suggested sources from links (university_id, university_name, url: base, link, anchor_text): the first of each (institution, type, url)."""
    rows = ordered(found).withColumn("link", F.regexp_extract("link", "^[^#]*", 0)).filter(keeps(text("url"), F.col("link")))
    rows = rows.withColumn("m", F.explode(labels(F.col("link"), text("anchor_text"))))
    rows = rows.select(text("university_id").alias("university_id"), text("university_name").alias("university_name"), F.col("m.source_type").alias("candidate_source_type"), F.col("link").alias("url"), text("anchor_text").alias("anchor_text"), fn.two_decimals(F.col("m.score")).alias("confidence_score"), F.col("m.reason").alias("reason"), ORDER)
    rest = ["university_name", "anchor_text", "confidence_score", "reason", ORDER]
    picked = rows.groupBy("university_id", "candidate_source_type", "url").agg(F.min_by(F.struct(*rest), ORDER).alias("r"))
    return picked.select(*[F.col(f"r.{c}").alias(c) if c in rest else c for c in SUGGESTION])


def in_order(df: DataFrame) -> DataFrame:
    return df.orderBy("university_id", "candidate_source_type", F.desc(F.col("confidence_score").cast("double")), "url")


def candidate_map(current: DataFrame, suggested: DataFrame, per_type_limit: int = 1) -> DataFrame:
    """The current map, reset, and for each institution and type the best suggestions whose url it doesn't use yet.

    Types choose in a fixed order and a url chosen by one is closed to later ones. So type t takes
    its best open rows in step t: ten steps of anti join and top-n, each materialised and
    distributed by institution; no institution is gathered into one task.
    """
    rows = conform(ordered(current), SOURCE)
    made = {
        "source_id": either("source_id", fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("url"))), "priority": either("priority", F.lit("1")), "crawl_method": either("crawl_method", F.lit("static")),
        "status": F.lit("pending"), "last_crawled_at": F.lit(""),
    }
    base = rows.select(*[made.get(c, F.col(c)).alias(c) for c in SOURCE], ORDER)
    meta = last_wins(rows, "university_id").select(F.col("university_id").alias("_u"), F.col("university_name").alias("_name"), F.col("country").alias("_country"), F.col("language_code").alias("_language"))
    offered = conform(ordered(suggested), SUGGESTION).filter(F.col("candidate_source_type").isin(*lx.CANDIDATE_TYPES))
    score = F.coalesce(F.col("confidence_score").try_cast("double"), F.lit(0.0))
    # a url once for each (institution, type): repeats would only be passed over
    offered = offered.groupBy("university_id", "candidate_source_type", "url").agg(F.min_by(F.struct("university_name", "reason", ORDER, (-score).alias("worse")), F.struct((-score).alias("worse"), ORDER)).alias("s"))
    offered = cut(offered)
    chosen = None
    used = cut(base.select("university_id", "url").distinct())
    for kind in lx.CANDIDATE_TYPES:
        open_ = offered.filter(F.col("candidate_source_type") == kind).join(used, ["university_id", "url"], "left_anti")
        best = Window.partitionBy("university_id").orderBy("s.worse", F.length("url"), "url")
        top = open_.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= per_type_limit)
        taken = cut(top.select("university_id", F.lit(kind).alias("source_type"), "url", F.col("s.university_name").alias("s_name"), F.col("s.reason").alias("reason")))
        chosen = taken if chosen is None else chosen.unionByName(taken)
        used = used.unionByName(taken.select("university_id", "url"))
    joined = chosen.join(meta, F.col("university_id") == F.col("_u"), "left")
    new = {
        "source_id": fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("url")), "university_name": F.coalesce("_name", "s_name"), "country": F.coalesce("_country", F.lit("")), "priority": F.lit("2"),
        "language_code": F.coalesce("_language", F.lit("")), "crawl_method": F.lit("static"), "status": F.lit("pending"), "last_crawled_at": F.lit(""), "notes": F.concat(F.lit("candidate from homepage link; review before promotion; "), F.col("reason")),
    }
    return base.select(*SOURCE).unionByName(joined.select(*[new.get(c, F.col(c)).alias(c) for c in SOURCE]))

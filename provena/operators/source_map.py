"""Source maps: validation, normalising, retries, repairs, merging of crawls, search and its promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provena import functions as fn
from provena import lexicons as lx
from provena.schemas import EVIDENCE, ORDER, SEARCH, SEED, SOURCE, conform, either, first_wins, last_wins, ordered, text


def priority() -> Column:
    """Whole-number priority of exported source maps, else 9."""
    return F.when(text("priority").rlike(r"^\d+$"), text("priority").try_cast("int")).otherwise(9)


def in_order(df: DataFrame) -> DataFrame:
    return df.orderBy("university_id", priority(), "source_type", "url", *[c for c in (ORDER,) if c in df.columns])


def _seeds(seed: DataFrame) -> DataFrame:
    rows = last_wins(ordered(seed), "university_id")
    return rows.select(text("university_id").alias("_seed"), text("name").alias("_seed_name"), text("country").alias("_seed_country"))


def _with_seed(df: DataFrame, seed: DataFrame, key: str = "university_id") -> DataFrame:
    return df.join(_seeds(seed), text(key) == F.col("_seed"), "left")


# --- validation ---------------------------------------------------------------------------------


def _errors(rows: DataFrame, *checks: tuple[Column, Column | str]) -> DataFrame:
    """One row (row_number, check, message) for each check that fails."""
    made = F.array(*[F.when(failed, F.struct(F.lit(k).alias("check"), (m if isinstance(m, Column) else F.lit(m)).alias("message"))) for k, (failed, m) in enumerate(checks)])
    return rows.select("row_number", F.explode(F.filter(made, lambda e: e.isNotNull())).alias("e")).select("row_number", "e.check", "e.message")


def _repeats(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with `repeat`: whether an earlier row has the same key."""
    firsts = rows.groupBy(*keys).agg(F.min("row_number").alias("_first"))
    return rows.join(firsts, list(keys)).withColumn("repeat", F.col("row_number") > F.col("_first"))


def numbered(df: DataFrame) -> DataFrame:
    """df with row_number, counted from 2 as in the file, and the order column dropped.

    Partition offsets come from counts, so no global window is needed.
    """
    rows = ordered(df).withColumn("_part", F.spark_partition_id()) if ORDER not in df.columns else df.withColumn("_part", F.lit(0))
    if ORDER in df.columns:
        return rows.withColumn("row_number", F.col(ORDER) + 2).drop("_part", ORDER)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min(ORDER).alias("_least"))
    offsets = sizes.select("_part", "_least", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    return rows.join(F.broadcast(offsets), "_part").withColumn("row_number", F.coalesce("_before", F.lit(0)) + F.col(ORDER) - F.col("_least") + 2).drop("_part", "_least", "_before", ORDER)


def validate_seed(seed: DataFrame) -> DataFrame:
    """Errors of a seed table: (row_number, check, message); rows count from 2, table errors have row 0 or a last number."""
    spark = seed.sparkSession
    schema = "row_number long, check int, message string"
    required = ("university_id", "name", "country", "city", "website_url", "type")
    if seed.isEmpty():
        return spark.createDataFrame([(0, 0, "seed CSV has no data rows")], schema)
    have = [c for c in seed.columns if c != ORDER]
    table = [(0, k, f"seed CSV missing required column: {c}") for k, c in enumerate(required) if c not in have]
    table += [(1 << 62, k, f"seed CSV has unsupported column: {c}") for k, c in enumerate(sorted(set(have) - set(SEED)))]
    rows = numbered(conform(seed, list(dict.fromkeys([*SEED, *have]))))
    label = F.concat(F.lit("seed row "), F.col("row_number").cast("string"), F.lit(": "))
    rows = _repeats(rows, "university_id")
    found = _errors(
        rows, (F.col("university_id") == "", F.concat(label, F.lit("missing university_id"))), ((F.col("university_id") != "") & F.col("repeat"), F.concat(label, F.lit("duplicate university_id "), F.col("university_id"))),
        ((F.col("website_url") != "") & ~fn.valid_url(F.col("website_url")), F.concat(label, F.lit("invalid website_url "), F.col("website_url"))),
    )
    return found.select(F.col("row_number").cast("long"), "check", "message").unionByName(spark.createDataFrame(table, schema))


def validate_sources(sources: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Errors of a source map: (row_number, check, message)."""
    spark = sources.sparkSession
    schema = "row_number long, check int, message string"
    required = ("university_id", "university_name", "country", "source_type", "url")
    if sources.isEmpty():
        return spark.createDataFrame([(0, 0, "source map CSV has no data rows")], schema)
    table = [(0, k, f"source map missing required column: {c}") for k, c in enumerate(required) if c not in sources.columns]
    rows = _repeats(numbered(conform(sources, SOURCE)), "university_id", "source_type", "url")
    known = F.lit(True)
    if seed is not None and not seed.isEmpty():
        ids = seed.select(text("university_id").alias("_seed")).distinct()
        rows = rows.join(ids, F.col("university_id") == F.col("_seed"), "left")
        known = F.col("_seed").isNotNull()
    label = F.concat(F.lit("source row "), F.col("row_number").cast("string"), F.lit(": "))
    method = either("crawl_method", F.lit("static"))
    whole = fn.as_int(F.col("priority"))
    say = lambda *parts: F.concat(label, *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    found = _errors(
        rows, (F.col("university_id") == "", say("missing university_id")), ((F.col("university_id") != "") & ~known, say("university_id ", F.col("university_id"), " not present in seed")),
        (~F.col("source_type").isin(*lx.SOURCE_TYPES), say("unsupported source_type ", F.col("source_type"))), (~method.isin(*lx.CRAWL_METHODS), say("unsupported crawl_method ", method)),
        (~fn.valid_url(F.col("url")), say("invalid url ", F.col("url"))), (F.col("repeat"), say("duplicate source for ", F.col("university_id"), " ", F.col("source_type"), " ", F.col("url"))),
        ((F.col("priority") != "") & whole.isNull(), say("priority must be an integer")), ((F.col("priority") != "") & (whole < 1), say("priority must be >= 1")),
    )
    return found.select(F.col("row_number").cast("long"), "check", "message").unionByName(spark.createDataFrame(table, schema))


# --- normalising --------------------------------------------------------------------------------


def judged_sources(sources: DataFrame) -> DataFrame:
    """Source rows with alias ids mapped, `mapped`, and `drop_reason`: blank_row, invalid_url, exact_duplicate or blank."""
    rows = ordered(sources)
    rows = conform(rows, list(dict.fromkeys([*SOURCE, *[c for c in rows.columns if c != ORDER]])))
    blank = F.lit(True)
    for c in rows.columns:
        if c != ORDER:
            blank = blank & (fn.squeeze(F.col(c)) == "")
    alias = fn.lookup(lx.ID_ALIASES, F.col("university_id"))
    rows = rows.withColumns({"mapped": alias.isNotNull() & ~blank, "university_id": F.coalesce(alias, F.col("university_id")), "drop_reason": F.when(blank, "blank_row").when(~fn.valid_url(F.col("url")), "invalid_url").otherwise("")})
    firsts = rows.filter("drop_reason = ''").groupBy("university_id", "source_type", "url").agg(F.min(ORDER).alias("_first"))
    joined = rows.join(firsts, ["university_id", "source_type", "url"], "left")
    return joined.withColumn("drop_reason", F.when((F.col("drop_reason") == "") & (F.col(ORDER) != F.col("_first")), "exact_duplicate").otherwise(F.col("drop_reason"))).drop("_first")


def normalize(seed: DataFrame, sources: DataFrame) -> DataFrame:
    """The valid, distinct source rows with defaults filled and names from the seed."""
    return filled(seed, judged_sources(sources))


def filled(seed: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows that judged_sources keeps, with defaults and names from the seed."""
    rows = _with_seed(judged.filter("drop_reason = ''"), seed)
    made = {
        "source_id": either("source_id", fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("url"))), "university_name": either("_seed_name", "university_name"), "country": either("_seed_country", "country"),
        "priority": either("priority", F.lit("2")), "language_code": either("language_code", F.lit("en")), "crawl_method": either("crawl_method", F.lit("static")), "status": either("status", F.lit("pending")),
    }
    return rows.select(*[made.get(c, F.col(c)).alias(c) for c in SOURCE], ORDER)


def normalize_counts() -> dict[str, Column]:
    """Aggregates over judged rows: input, output, mapped ids and rows removed by reason."""
    n = lambda reason: F.count_if(F.col("drop_reason") == reason)
    return {"input_rows": F.count(F.lit(1)), "output_rows": n(""), "mapped_university_ids": F.count_if("mapped"), "removed_blank_rows": n("blank_row"), "removed_invalid_url_rows": n("invalid_url"), "removed_exact_duplicates": n("exact_duplicate")}


def normalize_stats(sources: DataFrame) -> DataFrame:
    """One row with normalize_counts."""
    return judged_sources(sources).agg(*[c.alias(k) for k, c in normalize_counts().items()])


def retry_map(sources: DataFrame, statuses: Sequence[str] = ("failed", "skipped"), source_types: Sequence[str] | None = None) -> DataFrame:
    """Rows of failed or skipped sources, reset to pending."""
    rows = conform(ordered(sources), SOURCE).filter(F.col("status").isin(*statuses))
    if source_types is not None:
        rows = rows.filter(F.col("source_type").isin(*source_types))
    made = {"priority": either("priority", F.lit("2")), "language_code": either("language_code", F.lit("en")), "crawl_method": either("crawl_method", F.lit("static")), "status": F.lit("pending"), "last_crawled_at": F.lit("")}
    return rows.select(*[made.get(c, F.col(c)).alias(c) for c in SOURCE], ORDER)


# --- repairs ------------------------------------------------------------------------------------


def repair_rows(repairs: DataFrame) -> DataFrame:
    """Repairs from any of the accepted headers; a url that isn't http(s) reads as blank."""
    rows = ordered(repairs)
    cell = lambda c: text(f"`{c}`") if c in rows.columns else F.lit("")
    url = F.btrim(fn.strip_chars(either(cell("url"), cell("new_url"), cell("New URL / Alternative")), " \t\r\n"), F.lit("()"))
    return rows.select(cell("university_id").alias("university_id"), cell("source_type").alias("source_type"), F.when(url.rlike("(?i)^https?://"), url).otherwise("").alias("url"), either(cell("crawl_method"), F.lit("static")).alias("crawl_method"), either(cell("notes"), cell("Action / Repair")).alias("notes"), ORDER)


def apply_repairs(seed: DataFrame, base: DataFrame, repairs: DataFrame) -> DataFrame:
    """The base map with repairs applied, all rows pending; `change` is updated, added or blank.

    A repair of (institution, type) goes to the first base row of that key; a repair of
    `all_sources` to all other rows of its institution; one without a base row is added.
    """
    rows, fixes = conform(ordered(base), SOURCE), repair_rows(repairs)
    keyed = last_wins(fixes.filter((F.col("university_id") != "") & (F.col("source_type") != "") & (F.col("source_type") != "all_sources") & (F.col("url") != "")), "university_id", "source_type")
    keyed = keyed.select(F.col("university_id").alias("k_uni"), F.col("source_type").alias("k_type"), F.col("url").alias("k_url"), F.col("crawl_method").alias("k_method"), F.col("notes").alias("k_notes"), F.col(ORDER).alias("k_ord"))
    whole = last_wins(fixes.filter((F.col("university_id") != "") & (F.col("source_type") == "all_sources")), "university_id").select(F.col("university_id").alias("w_uni"), F.col("crawl_method").alias("w_method"), F.col("notes").alias("w_notes"))
    firsts = rows.groupBy("university_id", "source_type").agg(F.min(ORDER).alias("first"))
    targets = firsts.join(keyed, (F.col("university_id") == F.col("k_uni")) & (F.col("source_type") == F.col("k_type"))).drop("university_id", "source_type")
    joined = rows.join(targets, (F.col("university_id") == F.col("k_uni")) & (F.col("source_type") == F.col("k_type")) & (F.col(ORDER) == F.col("first")), "left").join(whole, F.col("university_id") == F.col("w_uni"), "left")
    joined = _with_seed(joined, seed)
    own, all_of = F.col("k_url").isNotNull(), F.col("w_uni").isNotNull()
    made = {
        "source_id": F.when(own, either("source_id", fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("k_url")))).otherwise(F.col("source_id")),
        "university_name": F.when(own, either("_seed_name", "university_name")).otherwise(F.col("university_name")), "country": F.when(own, either("_seed_country", "country")).otherwise(F.col("country")), "url": F.when(own, F.col("k_url")).otherwise(F.col("url")),
        "priority": F.when(own, either("priority", F.lit("2"))).otherwise(F.col("priority")), "language_code": F.when(own, either("language_code", F.lit("en"))).otherwise(F.col("language_code")),
        "crawl_method": F.when(own, either("k_method", "crawl_method", F.lit("static"))).when(all_of, either("w_method", "crawl_method")).otherwise(F.col("crawl_method")),
        "status": F.lit("pending"), "last_crawled_at": F.lit(""), "notes": F.when(own, either("k_notes", "notes")).when(all_of, either("w_notes", "notes")).otherwise(F.col("notes")),
    }
    changed = joined.select(*[made.get(c, F.col(c)).alias(c) for c in SOURCE], F.when(own | all_of, "updated").otherwise("").alias("change"), F.struct(F.lit(0).alias("side"), F.col(ORDER).alias("at")).alias(ORDER))
    new = _with_seed(keyed.join(firsts, (F.col("k_uni") == F.col("university_id")) & (F.col("k_type") == F.col("source_type")), "left_anti"), seed, "k_uni")
    added = {
        "source_id": fn.stable_id("src", F.col("k_uni"), F.col("k_type"), F.col("k_url")), "university_id": F.col("k_uni"), "university_name": text("_seed_name"), "country": text("_seed_country"), "source_type": F.col("k_type"), "url": F.col("k_url"),
        "priority": F.lit("2"), "language_code": F.lit("en"), "crawl_method": F.col("k_method"), "status": F.lit("pending"), "last_crawled_at": F.lit(""), "notes": F.col("k_notes"),
    }
    return changed.unionByName(new.select(*[added[c].alias(c) for c in SOURCE], F.lit("added").alias("change"), F.struct(F.lit(1).alias("side"), F.col("k_ord").alias("at")).alias(ORDER)))


# --- merging of crawls --------------------------------------------------------------------------


def merge_crawl(base: DataFrame, retry: DataFrame, columns: Sequence[str], good: str, listed: Sequence[str]) -> DataFrame:
    """Base rows, each replaced by the last retry row of its source if that is good, or if the base isn't and the retry is one of the listed failures. `replaced` tells which."""
    rows = conform(ordered(base), list(columns))
    again = last_wins(conform(ordered(retry), list(columns)).withColumn("_sid", F.col("source_id")), "_sid").select("_sid", F.struct(*columns).alias("_r"))
    joined = rows.join(again, F.col("source_id") == F.col("_sid"), "left")
    status, new = F.col("status"), F.col("_r.status")
    wins = F.coalesce((new == good) | (status != good) & new.isin(*listed), F.lit(False))
    return joined.select(*[F.when(wins, F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) for c in columns], wins.alias("replaced"), ORDER)


def merge_sources(base: DataFrame, retry: DataFrame) -> DataFrame:
    return merge_crawl(base, retry, SOURCE, "fetched", ("failed", "skipped"))


def merge_evidence(base: DataFrame, retry: DataFrame) -> DataFrame:
    return merge_crawl(base, retry, EVIDENCE, "ok", ("failed", "empty", "playwright_required"))


# --- search -------------------------------------------------------------------------------------


def search_requests(seed: DataFrame, existing: DataFrame, source_types: Sequence[str]) -> DataFrame:
    """A query for each institution and source type that has no source yet."""
    kinds = sorted(source_types)
    rows = conform(ordered(seed), SEED)
    wanted = rows.withColumn("source_type", F.explode(F.array(*map(F.lit, kinds))))
    have = existing.select(text("university_id").alias("_u"), text("source_type").alias("_t")).distinct()
    open_ = wanted.join(have, (F.col("university_id") == F.col("_u")) & (F.col("source_type") == F.col("_t")), "left_anti")
    template = F.coalesce(fn.lookup(lx.QUERY_TEMPLATES, F.col("source_type")), F.concat(F.lit("{name} "), F.replace(F.col("source_type"), F.lit("_"), F.lit(" ")), F.lit(" official")))
    return open_.withColumn("search_query", F.replace(template, F.lit("{name}"), F.col("name")))


def candidate_confidence(host_fits: Column, source_type: Column, joined: Column, host: Column, rank: Column) -> Column:
    hits = F.aggregate(F.split(source_type, "_"), F.lit(0.0), lambda n, t: n + F.when(F.contains(joined, t), 0.05).otherwise(0.0))
    official = joined.contains("official") | host.contains(".edu") | host.contains(".ac.")
    score = F.lit(0.45) + F.when(host_fits, 0.25).otherwise(0.0) + hits + F.when(official, 0.05).otherwise(0.0) - F.greatest(rank - 1, F.lit(0)) * 0.03
    return F.greatest(F.lit(0.05), F.least(score, F.lit(0.95)))


def search_candidates(requests: DataFrame, results: DataFrame, per_type_limit: int = 3) -> DataFrame:
    """Rows to review from search results (search_query, rank, link, title, snippet); links other than http(s) go, but keep their rank."""
    hits = results.filter((F.col("rank") <= per_type_limit) & text("link").rlike("^https?://")).select(F.col("search_query").alias("_q"), "rank", F.trim(text("link")).alias("candidate_url"), text("title").alias("title"), text("snippet").alias("snippet"))
    joined = requests.join(hits, F.col("search_query") == F.col("_q"))
    host, site = fn.url_host(F.col("candidate_url")), F.replace(fn.url_host(text("website_url")), F.lit("www."), F.lit(""))
    words = F.lower(F.concat_ws(" ", "title", "snippet", "candidate_url"))
    score = candidate_confidence((fn.url_host(text("website_url")) != "") & host.endswith(site), F.col("source_type"), words, host, F.col("rank"))
    made = {"university_name": F.col("name"), "confidence_score": fn.two_decimals(score), "review_status": F.lit("needs_review"), "crawl_method": F.lit("static"), "notes": F.lit("Serper candidate; review before promotion"), "rank": F.col("rank").cast("string")}
    return joined.select(*[made.get(c, F.col(c)).alias(c) for c in SEARCH])


def bare_url(value: Column) -> Column:
    return F.btrim(F.regexp_replace(value, f"{fn.WS}+", ""), F.lit("()"))


def promote(seed: DataFrame, base: DataFrame, candidates: DataFrame) -> DataFrame:
    """The base map and the approved candidates that it lacks; of candidates with one key the first."""
    rows = conform(ordered(base), SOURCE)
    found = ordered(candidates)
    cell = lambda c: text(c) if c in found.columns else F.lit("")
    picked = found.filter(F.lower(cell("review_status")) == "approved").select(
        cell("university_id").alias("university_id"), cell("source_type").alias("source_type"), bare_url(either(cell("manual_url"), cell("candidate_url"))).alias("url"), cell("university_name").alias("university_name"),
        cell("country").alias("country"), either(cell("crawl_method"), F.lit("static")).alias("crawl_method"), either(cell("notes"), F.concat(F.lit("promoted from Serper rank "), cell("rank"))).alias("notes"), ORDER,
    ).filter("university_id <> '' and source_type <> '' and url <> ''")
    have = rows.select(F.col("university_id").alias("_u"), F.col("source_type").alias("_t"), bare_url(F.col("url")).alias("_l")).distinct()
    new = first_wins(picked, "university_id", "source_type", "url").join(have, (F.col("university_id") == F.col("_u")) & (F.col("source_type") == F.col("_t")) & (F.col("url") == F.col("_l")), "left_anti")
    new = _with_seed(new, seed)
    made = {
        "source_id": fn.stable_id("src", F.col("university_id"), F.col("source_type"), F.col("url")), "university_name": F.coalesce("_seed_name", "university_name"), "country": F.coalesce("_seed_country", "country"),
        "priority": F.lit("2"), "language_code": F.lit(""), "status": F.lit("pending"), "last_crawled_at": F.lit(""),
    }
    side = lambda k: F.struct(F.lit(k).alias("side"), F.col(ORDER).alias("at")).alias(ORDER)
    return rows.select(*SOURCE, side(0)).unionByName(new.select(*[made.get(c, F.col(c)).alias(c) for c in SOURCE], side(1)))


def starter(seed: DataFrame) -> DataFrame:
    """A first source map: the homepage of each institution."""
    rows = conform(ordered(seed), SEED)
    made = {
        "source_id": fn.stable_id("src", F.col("university_id"), F.lit("official_home"), F.col("website_url")), "university_name": F.col("name"), "source_type": F.lit("official_home"), "url": F.col("website_url"),
        "priority": F.lit("1"), "crawl_method": F.lit("static"), "status": F.lit("pending"), "notes": F.lit("starter source generated from seed website_url; curate before crawling"),
    }
    return rows.select(*[made.get(c, F.col(c) if c in ("university_id", "country") else F.lit("")).alias(c) for c in SOURCE], ORDER)

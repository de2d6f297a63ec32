"""Evidence quality: an ordered classification of fetched texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena import functions as fn
from provena.lexicons import BLOCK_MARKERS, BLOCKS, SIGNALS
from provena.schemas import ORDER, either, last_wins, ordered, text

RESULT = ("content_quality_status", "content_quality_reason", "text_len", "content_signal_score")


def signal_score(source_type: Column, lowered: Column) -> Column:
    """Share of a source type's keywords in the text, over at least two; 0.5 for a type without keywords."""
    out = F.lit(0.5)
    for kind, words in SIGNALS.items():
        hits = sum((lowered.contains(w).cast("int") for w in words[1:]), lowered.contains(words[0]).cast("int"))
        out = F.when(source_type == kind, F.least(F.lit(1.0), hits / F.lit(float(max(2, len(words)))))).otherwise(out)
    return out


def classify(source_type: Column, title: Column, body: Column, fetch_status: Column, error: Column) -> Column:
    """Struct (status, reason, score) of one text; the first rule that holds decides."""
    joined = F.lower(F.concat_ws(" ", title, body))
    score = signal_score(source_type, joined)

    def result(status: Column | str, reason: Column | str, value: Column | float) -> Column:
        as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(as_column(status).alias("status"), as_column(reason).alias("reason"), as_column(value).cast("double").alias("score"))

    rules = F.when(fetch_status == "failed", result("fetch_failed", F.when(error != "", error).otherwise("fetch failed"), 0.0))
    for status, patterns in BLOCKS.items():
        rules = rules.when(fn.contains_any(joined, patterns), result(status, f"matched {status} pattern", 0.0))
    size = F.length(body)
    rules = rules.when(size < 120, result("too_short", "text_len < 120", 0.0)).when(size < 800, result("too_short", "text_len < 800", 0.15))
    rules = rules.when(score <= 0, result("low_signal", F.concat(F.lit("missing expected keywords for "), source_type), 0.2))
    return rules.otherwise(result("usable", "passed basic content checks", score))


def classify_evidence(sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence with its quality columns set anew; each row's source type comes from the last source of its id."""
    kinds = last_wins(ordered(sources), "source_id").select(text("source_id").alias("_sid"), text("source_type").alias("_type"))
    rows = ordered(evidence)
    fetched = F.when(text("fetch_status") != "", F.col("fetch_status")).otherwise(F.when(text("status") == "ok", "fetched").otherwise("failed"))
    joined = rows.join(kinds, text("source_id") == F.col("_sid"), "left").withColumn("fetch_status", fetched)
    found = joined.withColumn("_q", classify(text("_type"), text("title"), text("extracted_text"), F.col("fetch_status"), text("error")))
    return found.withColumns({
        "content_quality_status": F.col("_q.status"), "content_quality_reason": F.col("_q.reason"),
        "text_len": F.length(text("extracted_text")), "content_signal_score": fn.two_decimals(F.col("_q.score")),
    }).drop("_q", "_sid", "_type")


def usable(df: DataFrame, strict: bool = False) -> Column:
    """Whether a row of evidence is usable: status ok, and quality usable (or, unless strict, not classified)."""
    kind = text("content_quality_status")
    return (text("status") == "ok") & ((kind == "usable") if strict else kind.isin("", "usable"))


def looks_blocked(body: Column) -> Column:
    return fn.contains_any(F.lower(body), BLOCK_MARKERS)

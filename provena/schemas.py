"""Tables of the pipeline: column lists, all strings at the edge, and helpers to bring a frame into shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = "_ord"

# The columns of each table, in the order of the exports.
SEED = "university_id name local_name country city region country_group website_url type notes".split()
SOURCE = "source_id university_id university_name country source_type url priority language_code crawl_method status last_crawled_at notes".split()
EVIDENCE = "evidence_id source_id university_id url title language_code content_hash extracted_text retrieved_at parser_version fetch_status content_quality_status content_quality_reason text_len content_signal_score status error".split()
FACT = "fact_id university_id program_id fact_type fact_key value_text value_json value_number value_currency value_date fact_origin evidence_id source_url supporting_text confidence_score review_status extracted_at".split()
PROGRAM = "program_id university_id name normalized_name degree_level field_of_study faculty campus language_of_instruction program_url status".split()
SEARCH = "university_id university_name country source_type candidate_url title snippet rank confidence_score search_query review_status crawl_method notes".split()
SUGGESTION = "university_id university_name candidate_source_type url anchor_text confidence_score reason".split()
RANKING_RAW = "ranking_provider ranking_year source_url rank_raw institution_name country city raw_json retrieved_at".split()
RANKING_NORMALIZED = "ranking_provider ranking_year institution_name normalized_name country city rank_raw rank_numeric rank_display ranking_source_url retrieved_at review_status notes".split()
RANKING_IMPORT = "university_id qs_rank the_rank arwu_rank rank_display ranking_source_url retrieved_at review_status notes".split()
MATCH_CANDIDATE = "university_id seed_name seed_country candidate_name candidate_country rank_raw rank_numeric rank_display confidence_score match_reason review_status ranking_source_url".split()
MATCH_REPORT = "university_id seed_name seed_country match_status matched_name matched_country qs_rank rank_display confidence_score ranking_source_url notes".split()
LLM_REPORT = "evidence_id source_id university_id source_type source_url status facts_emitted error model".split()
COUNTRY_COST = "country country_code annual_living_usd_min annual_living_usd_max currency source_url source_type confidence_score retrieved_at review_status notes".split()
REPAIR = "university_id source_type url crawl_method notes".split()
PRODUCT = (
    "university_id display_name local_name country city region country_group type website_url image_url short_description qs_rank the_rank arwu_rank rank_display "
    "subject_tags study_level_tags campus_vibe_tags support_tags tuition_usd_min tuition_usd_max living_cost_usd_min living_cost_usd_max total_cost_usd_min total_cost_usd_max "
    "scholarship_available application_system deadline_summary english_requirement_summary cert_requirement_summary cert_requirement_tags portfolio_required interview_required "
    "requirement_summary strengths best_for weaknesses writer_context evidence_coverage_score data_quality_score import_status review_status"
).split()
MATCHING = "university_id subject_tags study_level_tags campus_vibe_tags support_tags tuition_usd_min tuition_usd_max living_cost_usd_min living_cost_usd_max total_cost_usd_min total_cost_usd_max cert_requirement_tags".split()
WRITER = "university_id writer_context strengths best_for weaknesses review_status".split()
QA = "university_id name source_count required_source_coverage evidence_count fact_count missing_must_have_fields evidence_coverage_score data_quality_score review_status".split()
BATCH_QA = (
    "university_id display_name source_count usable_evidence_count blocked_evidence_count failed_source_count tuition_fact_count valid_tuition_fact_count deadline_fact_count "
    "valid_deadline_fact_count english_fact_count valid_english_fact_count matching_tag_count has_product_profile import_status qa_status qa_notes"
).split()
GATE = "metric value threshold status notes".split()
GAP = "university_id display_name missing_field import_status".split()


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def text(column: str | Column) -> Column:
    """A cell as text: null reads as the empty string."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def either(*columns: str | Column) -> Column:
    """The first cell that isn't blank, else the empty string."""
    return F.coalesce(*[F.nullif(text(c), F.lit("")) for c in columns], F.lit(""))


def conform(df: DataFrame, columns: list[str], keep: tuple[str, ...] = (ORDER,)) -> DataFrame:
    """df with exactly these columns as text (absent ones blank), and the order column where it has one."""
    have = set(df.columns)
    return df.select(*[text(f"`{c}`") .alias(c) if c in have else F.lit("").alias(c) for c in columns], *[c for c in keep if c in have])


def ordered(df: DataFrame) -> DataFrame:
    """df with its rows numbered in reading order, if it isn't numbered yet."""
    return df if ORDER in df.columns else df.withColumn(ORDER, F.monotonically_increasing_id())


def order_key(df: DataFrame) -> Column:
    """The order column as an array of numbers, whatever parts it has; arrays compare part by part."""

    def parts(name: str, kind: T.DataType) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [p for f in kind.fields for p in parts(f"{name}.{f.name}", f.dataType)]
        return [F.col(name) if isinstance(kind, T.ArrayType) else F.array(F.col(name).cast("long"))]

    return F.concat(*parts(ORDER, df.schema[ORDER].dataType))


def last_wins(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: the last one read. A hash aggregate with map-side combine, not a window."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ORDER)).alias("row"))
    return picked.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def first_wins(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: the first one read."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(ORDER)).alias("row"))
    return picked.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])

"""Column builders: native expressions with the pipeline's text, number and id semantics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from provena.schemas import text

#: White space as Unicode text knows it (Java's own \s is ASCII only).
WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def squeeze(value: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(value, f"{WS}+", " "))


def squeeze_ends(value: Column) -> Column:
    """White space removed at the ends only."""
    return F.regexp_replace(value, f"^{WS}+|{WS}+$", "")


def strip_chars(value: Column, chars: str) -> Column:
    return F.btrim(value, F.lit(chars))


def clean_sentence(value: Column) -> Column:
    return strip_chars(F.regexp_replace(value, f"{WS}+", " "), " .;:-")


def clean_summary(value: Column, length: int) -> Column:
    """A short text for a summary: squeezed, stripped, blank if it holds a page marker, cut at a word's end."""
    from provena.lexicons import SUMMARY_JUNK

    marks = " ;,.:-"
    cleaned = strip_chars(F.regexp_replace(value, f"{WS}+", " "), marks)
    head = F.substring(cleaned, 1, length)
    short = strip_chars(F.regexp_replace(head, r"(?s) [^ ]*$", ""), marks)
    return F.when(contains_any(F.lower(cleaned), SUMMARY_JUNK), "").when(F.length(cleaned) > length, short).otherwise(cleaned)


def contains_any(lowered: Column, words: Sequence[str]) -> Column:
    """Whether one of the words is a substring."""
    out = F.lit(False)
    for word in words:
        out = out | lowered.contains(word)
    return out


def first_tag(lowered: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """The first tag of the lexicon, in its order, with a word in the text; else blank."""
    return F.coalesce(*[F.when(contains_any(lowered, words), F.lit(tag)) for tag, words in lexicon.items()], F.lit(""))


def tags(lowered: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """All tags of the lexicon with a word in the text, in its order."""
    return F.filter(F.array(*[F.when(contains_any(lowered, words), F.lit(tag)) for tag, words in lexicon.items()]), lambda t: t.isNotNull())


def lookup(table: Mapping[str, object], key: Column) -> Column:
    """The value of a literal table, null where the key is absent."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 16 hex digits of the SHA-1 of the trimmed, lower-cased parts joined by a bar."""
    ready = [F.lower(F.regexp_replace(text(p), f"^{WS}+|{WS}+$", "")) for p in parts]
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat_ws("|", *ready).cast("binary")), 1, 16))


def two_decimals(value: Column) -> Column:
    """Two decimals as text, halves to even."""
    return F.format_string("%.2f", F.bround(value, 2))


def three_decimals(value: Column) -> Column:
    return F.format_string("%.3f", F.bround(value, 3))


def as_int(value: Column) -> Column:
    """A text of digits as a whole number; null for anything else, decimals included."""
    return F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), value.try_cast("long"))


def json_text(value: Column) -> Column:
    """A text as a JSON string with its quotes."""
    wrapped = F.to_json(F.struct(F.coalesce(value, F.lit("")).alias("v")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def json_object(**fields: Column) -> Column:
    """A JSON object with sorted keys, `, ` and `: ` as separators; the fields are JSON already."""
    parts = [F.concat(F.lit(f'"{key}": '), fields[key]) for key in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def json_array(values: Column) -> Column:
    """An array of texts as JSON with `, ` between."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, json_text), ", "), F.lit("]"))


def sentences(value: Column) -> Column:
    return F.split(value, rf"(?<=[.!?]){WS}+")


def truth(value: Column) -> Column:
    """true, false or null for anything else."""
    low = F.lower(value)
    return F.when(low == "true", True).when(low == "false", False)


def valid_url(value: Column) -> Column:
    """http(s) with a host, or file with a path."""
    return F.coalesce(value.rlike(r"(?i)^https?://[^/?#]+") | value.rlike(r"(?i)^file:(?://[^/?#]*)?[^?#/]*/?[^?#]*$") & value.rlike(r"(?i)^file:(?://[^/?#]*/|[^/]|/[^/])"), F.lit(False))


def url_host(value: Column) -> Column:
    return F.lower(F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_scheme(value: Column) -> Column:
    return F.lower(F.regexp_extract(value, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_path(value: Column) -> Column:
    return F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def comparable_domain(host: Column) -> Column:
    """The last two labels of a host, three under a two-part suffix; no port, no www."""
    from provena.lexicons import TWO_PART_SUFFIXES

    bare = F.regexp_replace(F.element_at(F.split(F.lower(host), ":"), 1), r"^www\.", "")
    labels = F.split(bare, r"\.")
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    return F.when((F.size(labels) >= 3) & last(2).isin(*TWO_PART_SUFFIXES), last(3)).when(F.size(labels) >= 2, last(2)).otherwise(bare)


def strip_accents(value: Column) -> Column:
    """Letters without their accents: compatibility forms of all characters, combining marks dropped."""
    from provena.functions import accents

    return accents.strip_accents(value)


def normalize_name(value: Column) -> Column:
    bare = F.regexp_replace(F.lower(strip_accents(value)), "&", " and ")
    bare = F.regexp_replace(bare, r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def simple_name(normalized: Column) -> Column:
    from provena.lexicons import NAME_STOPWORDS

    return F.array_join(F.filter(F.split(normalized, " "), lambda t: (t != "") & ~t.isin(*NAME_STOPWORDS)), " ")


def normalize_country(value: Column) -> Column:
    from provena.lexicons import COUNTRY_ALIASES

    name = normalize_name(value)
    return F.coalesce(lookup(COUNTRY_ALIASES, name), name)


def rank_number(value: Column) -> Column:
    """The first whole number in a rank text."""
    return F.regexp_extract(F.regexp_replace(value, "[#=]", ""), r"(\d+)", 1)


def is_range(value: Column) -> Column:
    return value.rlike(r"\d+\s*[-+]\s*\d*|\d+\+")


def usd(amount: Column, currency: Column) -> Column:
    """Whole dollars, halves to even; null for an unknown currency."""
    from provena.lexicons import USD

    return F.bround(amount * lookup(USD, F.upper(currency)), 0).cast("long")


def visible_text(html: Column) -> Column:
    """Text of a page by pattern: scripts and styles out, then tags, then white space. Entities stay (the parser in sources.html unescapes them)."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b[^>]*>.*?</(script|style|noscript)>", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    return squeeze(bare)

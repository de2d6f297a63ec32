"""URL filters: pattern rules indexed by their rarest literal token.

Two kinds of rules share one index:

* host rules such as `net/` or `example.net/en/`: host (with all subdomains) and path prefix; the
  longest that fits wins (ties: the longer host, then block before allow) and beats any pattern.
* patterns such as `||ads.example^`, `/wp-admin/` or `@@/press/`: literal text with `*` for
  anything, `^` for a separator or the end, `||` for a host label's start, `@@` for an exception.
  An exception that matches beats all blocking patterns.

Each rule is filed under its rarest literal token (rarest over the URLs judged: one aggregate over
the tokens that rules contain). The tokens of a URL fetch its candidate rules; only those run
their regular expressions. Rules without a literal token are filed under the empty token, which
every URL has. Everything is a DataFrame expression.

Up to `inline_tokens` distinct index tokens the index is a literal map (the list is the caller's,
so its size is known on the driver); beyond, it is a table joined on the token.

Defined results: a null url, or one without `://`, has an empty host and path, no rule, and is
allowed unless a pattern matches its text; repeated rows and ties are judged row by row; a null id
is carried through; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import ascii_lower

#: The host rules of the production list: (rule, verdict).
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The pattern rules of the production list.
PATTERNS = ("||doubleclick.net^", "||adserver.", "/cgi-bin/", "/wp-admin/", "/wp-login.php", "/login/", "/signin/", "/checkout/", "?sessionid=", "&sessionid=", "?phpsessid=", "&phpsessid=", "/search?q=", "/casino/", "/xxx/", "@@/press/release/")
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    host: bool
    length: int
    host_length: int
    regex: str
    tokens: tuple[str, ...]


def host_rule(text: str, action: str) -> Rule:
    """Its regular expression runs over host and path, its tokens are whole tokens of both."""
    host, slash, path = text.partition("/")
    path = slash + path
    tokens = re.findall(r"[A-Za-z0-9]+", host)
    tokens += re.findall(r"[A-Za-z0-9]+(?![A-Za-z0-9]|$)", path)
    return Rule(text, action, True, len(text), len(host), rf"(?s)^(?:[^/]*\.)?{_literal(host)}{_literal(path)}", tuple(t.lower() for t in tokens))


def pattern_rule(text: str) -> Rule:
    """Its regular expression runs over the lower-cased url."""
    body = text.removeprefix("@@").lower()
    anchored, core = body.startswith("||"), body.removeprefix("||")
    regex = "".join({"*": ".*", "^": SEPARATOR}.get(c, _literal(c)) for c in core)
    head = r"^[^/?#]*?://(?:[^/?#]*\.)?" if anchored else ""
    bounded = ("|" if anchored else "*") + core + "*"
    tokens = re.findall(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", bounded)
    return Rule(text, "allow" if text.startswith("@@") else "block", False, len(text), 0, f"(?s){head}{regex}", tuple(tokens))


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/ ])", r"\\\1", text)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url."""
    return F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce(url, F.lit(""))), F.lit("[a-z0-9]+"), 0))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many urls have each of the rules' tokens: at most one row for each token of the rule list reaches the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    if len(wanted) <= 512:
        held = urls.select(F.explode(F.array_intersect(tokens_of(F.col("url")), F.array(*map(F.lit, wanted)))).alias("token"))
    else:
        table = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        held = urls.select(F.explode(tokens_of(F.col("url"))).alias("token")).join(table, "token", "left_semi")
    return {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}


def index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Token to the numbers of the rules filed under it; those without a token are under the empty one."""
    filed: dict[str, list[int]] = {}
    for k, rule in enumerate(rules):
        filed.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=""), []).append(k)
    return filed


def _row(rule: Rule) -> Column:
    return F.struct(F.lit(rule.name).alias("name"), F.lit(rule.action).alias("action"), F.lit(rule.host).alias("host"), F.lit(rule.length).alias("length"), F.lit(rule.host_length).alias("host_length"), F.lit(rule.regex).alias("regex"))


ROW = "name string, action string, host boolean, length int, host_length int, regex string"


def _best(matched: Column, wanted: Column) -> Column:
    """The strongest of matched rules, as a struct whose last field is the rule: longest, longer host, block."""
    order = F.transform(F.filter(matched, lambda r: wanted(r)), lambda r: F.struct(r["length"].alias("a"), r["host_length"].alias("b"), (r["action"] == "block").alias("c"), r["name"].alias("d"), r["action"].alias("e")))
    return F.array_max(order)


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", host_rules: Sequence[tuple[str, str]] = HOST_RULES, patterns: Sequence[str] = PATTERNS, inline_tokens: int = 512) -> DataFrame:
    """id, host, path, rule, verdict, pattern (the pattern that decided, else null) for each row."""
    rules = [host_rule(*r) for r in host_rules] + [pattern_rule(p) for p in patterns]
    urls = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    filed = index(rules, token_counts(urls, rules))
    # no token can fetch these, so every url is tried in the projection and none of them meets the join
    loose = [rules[k] for k in filed.pop("", [])]
    parsed = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "tokens": tokens_of(F.col("url")), "low": ascii_lower(F.coalesce("url", F.lit("")))})
    subject = F.concat("host", "path")
    matches = lambda r: F.regexp_like(F.when(r["host"], subject).otherwise(F.col("low")), r["regex"])
    if not filed:
        judged = parsed.withColumn("matched", F.expr(f"from_json('[]', 'array<struct<{ROW.replace(' ', ':').replace(',:', ',')}>>')"))
    elif len(filed) <= inline_tokens:
        fetched = F.flatten(F.transform(F.filter(F.col("tokens"), lambda t: t.isin(*filed)), lambda t: F.element_at(F.create_map(*[x for token, held in filed.items() for x in (F.lit(token), F.array(*[_row(rules[k]) for k in held]))]), t)))
        judged = parsed.withColumn("matched", F.filter(fetched, matches))
    else:
        table = df.sparkSession.createDataFrame([(token, (r.name, r.action, r.host, r.length, r.host_length, r.regex)) for token, held in filed.items() for r in (rules[k] for k in held)], f"token string, rule struct<{ROW.replace(' ', ':').replace(',:', ',')}>")
        distinct = parsed.select("url", "host", "path", "low", "tokens").distinct()
        found = distinct.withColumn("token", F.explode("tokens")).join(table, "token").filter(matches(F.col("rule"))).groupBy("url").agg(F.collect_set("rule").alias("matched"))
        judged = parsed.join(found.withColumnRenamed("url", "found_url"), F.col("url").eqNullSafe(F.col("found_url")), "left").withColumn("matched", F.coalesce("matched", F.expr(f"from_json('[]', 'array<struct<{ROW.replace(' ', ':').replace(',:', ',')}>>')")))
    if loose:
        judged = judged.withColumn("matched", F.concat("matched", F.filter(F.array(*map(_row, loose)), matches)))
    judged = judged.withColumns({
        "by_host": _best(F.col("matched"), lambda r: r["host"]),
        "by_exception": _best(F.col("matched"), lambda r: ~r["host"] & (r["action"] == "allow")),
        "by_pattern": _best(F.col("matched"), lambda r: ~r["host"] & (r["action"] == "block")),
    })
    decided = F.coalesce(F.col("by_exception"), F.col("by_pattern"))
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("by_host.d").alias("rule"),
        F.coalesce(F.col("by_host.e"), decided["e"], F.lit("allow")).alias("verdict"),
        F.when(F.col("by_host").isNull(), decided["d"]).alias("pattern"),
    )

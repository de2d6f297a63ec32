"""Addresses: taking them apart and resolving relative ones (RFC 3986, with the usual leniencies), as Columns.

An intermediate result is bound by a transform over an array of one (`let`), so it is computed once however
often it is used.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Schemes whose addresses may be relative, those with an authority, and those with parameters in their last segment.
RELATIVE = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
WITH_AUTHORITY = (*RELATIVE, "telnet", "snews", "rsync", "nfs", "git", "git+ssh", "itms-services")
WITH_PARAMETERS = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def disguised() -> str:
    """A class of the characters that turn into a delimiter when they are normalised."""
    return "".join(rf"\x{{{c:x}}}" for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and set(unicodedata.normalize("NFKC", chr(c))) & set("/?#@:"))


DISGUISED = f"[{disguised()}]"


def parts(url: Column, scheme: Column) -> Column:
    """Struct (scheme, authority, path, parameters, query, fragment, broken) of an address; `scheme` where it names none.

    broken: the authority has one bracket only, brackets without an address, or characters that would become delimiters.
    """
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def of(u: Column) -> Column:
        named = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        return F.struct(F.when(named != "", F.lower(named)).otherwise(scheme).alias("scheme"), F.when(named != "", F.regexp_replace(u, "^[^:]*:", "")).otherwise(u).alias("rest"))

    def rest(u: Column) -> Column:
        after = F.when(F.startswith(u["rest"], F.lit("//")), F.regexp_replace(u["rest"], "^//[^/?#]*", "")).otherwise(u["rest"])
        return F.struct(u["scheme"].alias("scheme"), F.regexp_extract(u["rest"], "^//([^/?#]*)", 1).alias("authority"), F.substring_index(after, "#", 1).alias("before"), F.regexp_extract(after, "(?s)^[^#]*#(.*)$", 1).alias("fragment"))

    def whole(u: Column) -> Column:
        path = F.substring_index(u["before"], "?", 1)
        split = u["scheme"].isin(*WITH_PARAMETERS)
        last = r"(?s)^((?:.*/)?[^/;]*);([^/]*)$"
        host = F.regexp_extract(u["authority"], r"\[([^\]]*)\]", 1)
        opens, closes = (F.contains(u["authority"], F.lit(b)) for b in "[]")
        return F.struct(
            u["scheme"].alias("scheme"), u["authority"].alias("authority"), F.when(split, F.regexp_replace(path, last, "$1")).otherwise(path).alias("path"), F.when(split, F.regexp_extract(path, last, 2)).otherwise("").alias("parameters"),
            F.regexp_extract(u["before"], r"(?s)^[^?]*\?(.*)$", 1).alias("query"), u["fragment"].alias("fragment"),
            ((opens != closes) | (opens & ~host.rlike(r"^(v[0-9A-Fa-f]+\..+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*)$")) | u["authority"].rlike(DISGUISED)).alias("broken"),
        )

    return let(let(let(clean, of), rest), whole)


def joined(scheme: Column, authority: Column, path: Column, parameters: Column, query: Column, fragment: Column) -> Column:
    full = F.when(parameters != "", F.concat(path, F.lit(";"), parameters)).otherwise(path)

    def of(p: Column) -> Column:
        rooted = F.when((p != "") & ~F.startswith(p, F.lit("/")), F.concat(F.lit("/"), p)).otherwise(p)
        open_ = F.startswith(p, F.lit("//")) | ((scheme != "") & scheme.isin(*WITH_AUTHORITY) & ((p == "") | F.startswith(p, F.lit("/"))))
        body = F.when(authority != "", F.concat(F.lit("//"), authority, rooted)).when(open_, F.concat(F.lit("//"), p)).otherwise(p)
        lead = lambda mark, value: F.when(value != "", F.concat(F.lit(mark), value)).otherwise("")
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), body, lead("?", query), lead("#", fragment))

    return let(full, of)


def merged_path(base: Column, path: Column) -> Column:
    """A relative path beside a base path, dot segments taken out: a fold over the segments that keeps a stack."""
    own = F.split(base, "/")
    folder = F.when(F.element_at(own, -1) != "", F.slice(own, F.lit(1), F.size(own) - 1)).otherwise(own)
    both = F.concat(folder, F.split(path, "/"))
    # empty segments stay at the ends only
    inner = F.filter(both, lambda s, k: (s != "") | (k == 0) | (k == F.size(both) - 1))
    segments = F.when(F.startswith(path, F.lit("/")), F.split(path, "/")).otherwise(inner)

    def of(all_: Column) -> Column:
        push = lambda stack, s: F.when(s == "..", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))).when(s == ".", stack).otherwise(F.array_append(stack, s))
        stack = F.aggregate(all_, F.array().cast("array<string>"), push)
        ends = F.element_at(all_, -1).isin(".", "..")
        return F.coalesce(F.nullif(F.array_join(F.when(ends, F.array_append(stack, F.lit(""))).otherwise(stack), "/"), F.lit("")), F.lit("/"))

    return let(segments, of)


def resolve(base: Column, link: Column) -> Column:
    """The address that a link on a page stands for; the link as it is where it can't be resolved, null where one of both is null."""

    def of(x: Column) -> Column:
        b, u = x["b"], x["u"]
        empty = (u["path"] == "") & (u["parameters"] == "")
        has = u["scheme"].isin(*WITH_AUTHORITY)
        authority = F.when(has, b["authority"]).otherwise(u["authority"])
        same = joined(u["scheme"], authority, b["path"], b["parameters"], F.when(u["query"] != "", u["query"]).otherwise(b["query"]), u["fragment"])
        beside = joined(u["scheme"], authority, merged_path(b["path"], u["path"]), u["parameters"], u["query"], u["fragment"])
        own = joined(u["scheme"], u["authority"], u["path"], u["parameters"], u["query"], u["fragment"])
        kept = b["broken"] | u["broken"] | (u["scheme"] != b["scheme"]) | ~u["scheme"].isin(*RELATIVE)
        return F.when(kept, x["link"]).when(has & (u["authority"] != ""), own).when(empty, same).otherwise(beside)

    with_base = let(parts(base, F.lit("")), lambda b: F.struct(b.alias("b"), parts(link, b["scheme"]).alias("u"), link.alias("link")))
    return F.when(base.isNull() | link.isNull(), None).when(base == "", link).when(link == "", base).otherwise(let(with_base, of))

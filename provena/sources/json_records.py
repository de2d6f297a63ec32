"""Ranking records in JSON that sits anywhere in a page."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

from provena import lexicons as lx

EMPTY = ("", None, [], {})
DECODER = json.JSONDecoder()


def payloads(text: str) -> Iterator[object]:
    """JSON values of a body: the whole body, else JSON script elements and values after the data markers."""
    whole = text.strip()
    if whole[:1] in ("{", "["):
        try:
            yield json.loads(whole)
            return
        except ValueError:
            pass
    for block in re.findall(r"(?is)<script[^>]+type=[\"']application/json[\"'][^>]*>(.*?)</script>", text):
        try:
            yield json.loads(html.unescape(block).strip())
        except ValueError:
            continue
    for marker in ("__NEXT_DATA__", "drupalSettings"):
        for hit in re.finditer(marker, text):
            for opening in "{[":
                at = text.find(opening, hit.start())
                if at >= 0:
                    try:
                        # the decoder stops at the value's own end
                        yield DECODER.raw_decode(text, at)[0]
                    except ValueError:
                        continue


def field(row: dict, keys: tuple[str, ...]) -> str:
    """The first key's value that isn't empty: exact names first, then names that contain one."""
    low = {k.lower(): v for k, v in row.items()}
    exact = (low.get(k) for k in keys)
    loose = (v for k, v in row.items() if any(part in k.lower() for part in keys))
    return next((str(v) for group in (exact, loose) for v in group if v not in EMPTY), "")


def stripped(value: str) -> str:
    return re.sub(r"<[^>]+>", "", html.unescape(value)).strip()


def walk(value: object) -> Iterator[dict]:
    """All objects of a JSON value, outer ones first, without recursion limits."""
    stack = [value]
    while stack:
        top = stack.pop()
        if isinstance(top, dict):
            yield top
            stack += reversed([v for v in top.values() if isinstance(v, (dict, list))])
        elif isinstance(top, list):
            stack += reversed(top)


def records_of_text(text: str) -> list[tuple[str, str, str, str, str]]:
    """(rank, institution, country, city, raw JSON) of every object with a name and a rank that has digits."""
    out = []
    for payload in payloads(text):
        for row in walk(payload):
            name, rank = field(row, lx.RECORD_NAME_KEYS), field(row, lx.RECORD_RANK_KEYS)
            if name and re.search(r"\d", rank):
                out.append((rank, stripped(name), stripped(field(row, lx.RECORD_COUNTRY_KEYS)), stripped(field(row, lx.RECORD_CITY_KEYS)), json.dumps(row, ensure_ascii=False, sort_keys=True)))
    return out

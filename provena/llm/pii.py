"""Personal data by anchor expansion.

An Aho-Corasick automaton over anchors (at-signs, plus signs, digits, URL schemes, identifier cue
words) walks each text once. At every anchor a deterministic local parser expands to both sides
and validates what it finds; no regular expression runs over the text.

Base kinds (leftmost, non-overlapping for each kind; a match that fails validation is dropped):
email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits).
Kinds that the method adds: `account` (an identifier after a cue word such as iban or account: a
valid IBAN, else groups with digits, 6 digits or more), `secret` (a value after a cue such as token=
or password:), `login` (user:password@ in a URL). Cue words and schemes count in any case.

Offsets are code points, the end exclusive. Defined results: a null or empty text has no spans; a
null id is carried through; repeated rows are judged row by row; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import annotate, columns

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("account", "secret", "login")
KINDS = BASE_KINDS + MORE_KINDS
DIGITS = frozenset("0123456789")
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
SECRET = ALNUM | frozenset("._-+/=")
ACCOUNT_CUES = ("iban", "account no", "account number", "kontonummer", "numéro de compte", "número de cuenta", "passport no", "passport number", "social security number", "ssn")
SECRET_CUES = ("token", "api_key", "apikey", "api key", "secret_key", "secret", "access_key", "password", "passwd")
SCHEMES = ("http://", "https://", "ftp://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://", "ssh://")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def run_end(text: str, at: int, allowed: frozenset[str]) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def run_start(text: str, at: int, allowed: frozenset[str], floor: int) -> int:
    """Start of the run of allowed characters that ends before `at`, not below floor."""
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def expand_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = run_start(text, at, LOCAL, floor)
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        more = run_end(text, end + 1, LABEL)
        if more == end + 1:
            break
        end, labels = more, labels + 1
    return (start, end) if labels else None


def expand_ip(text: str, at: int) -> tuple[int, bool] | None:
    """End and whether it's valid, from the start of a run of digits."""
    end, parts = run_end(text, at, DIGITS), []
    parts.append(text[at:end])
    while len(parts) < 4:
        if end >= len(text) or text[end] != ".":
            return None
        more = run_end(text, end + 1, DIGITS)
        if more == end + 1:
            return None
        parts.append(text[end + 1 : more])
        end = more
    return end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def expand_card(text: str, at: int) -> tuple[int, str] | None:
    digits, end, n = [], at, len(text)
    while True:
        more = run_end(text, end, DIGITS)
        digits.append(text[end:more])
        end = more
        if end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
            end += 1
        else:
            break
    found = "".join(digits)
    return (end, found) if len(found) > 1 else None


def expand_phone(text: str, at: int) -> tuple[int, int] | None:
    """End and number of digits, from a plus sign."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in DIGITS:
        return None
    return end, sum(c in DIGITS for c in text[at:end])


def after_cue(text: str, at: int, signs: str) -> int | None:
    """Where a value starts after a cue and one of the signs, with blanks and an opening quote around; None without a sign."""
    n = len(text)
    if at < n and text[at] in "\"'":
        at += 1
    while at < n and text[at] == " ":
        at += 1
    if at >= n or text[at] not in signs:
        return None
    at += 1
    while at < n and text[at] == " ":
        at += 1
    return at + 1 if at < n and text[at] in "\"'" else at


def expand_secret(text: str, at: int) -> tuple[int, int] | None:
    start = after_cue(text, at, "=:")
    if start is None:
        return None
    end = run_end(text, start, SECRET)
    while end > start and text[end - 1] in ".":
        end -= 1
    value = text[start:end]
    return (start, end) if len(value) >= 8 and any(c in DIGITS for c in value) else None


def iban(text: str) -> bool:
    """Country letters, check digits and up to 30 more, whose remainder by 97 is 1."""
    if not (15 <= len(text) <= 34 and text[:2].isalpha() and text[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def groups(text: str, at: int) -> Iterator[int]:
    """Ends of the value that starts at `at`: of its first run of letters and digits, then with each further run behind a blank or hyphen."""
    end = run_end(text, at, ALNUM)
    while end > at:
        yield end
        more = run_end(text, end + 1, ALNUM) if end < len(text) and text[end] in " -" else end
        if more <= end + 1:
            return
        end = more


def expand_account(text: str, at: int) -> tuple[int, int] | None:
    """An identifier after a cue: the longest valid IBAN, else what has 6 digits or more, in groups that each hold a digit."""
    start = after_cue(text, at, ":#.")
    if start is None:
        start = at + (at < len(text) and text[at] == " ")
    best, last, digits = None, start, 0
    open_ = True
    for end in groups(text, start):
        if end - start > 42:
            break
        if iban("".join(c for c in text[start:end] if c in ALNUM).upper()):
            return start, end
        own = sum(c in DIGITS for c in text[last:end])
        open_ = open_ and own > 0
        digits += own
        if open_ and digits >= 6:
            best = (start, end)
        last = end
    return best


def expand_login(text: str, at: int) -> tuple[int, int] | None:
    """user:password before the at-sign of a URL, from the end of its scheme."""
    end, colon = at, -1
    while end < len(text) and text[end] not in "/?# \t\n\r\"'<>":
        if text[end] == "@":
            return (at, end) if at < colon < end - 1 else None
        if text[end] == ":" and colon < 0:
            colon = end
        end += 1
    return None


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor in "@+0123456789":
        found.add_word(anchor, (anchor if anchor in "@+" else "digit", 1))
    for kind, words in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("login", SCHEMES)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def folded(text: str) -> str:
    """The text in lower case, of the same length: cues are found in any spelling at the text's own offsets."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def find(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)
    seen_digit = 0
    for last, (what, size) in anchors.iter(folded(text)):
        if what == "digit":
            if last < seen_digit:
                continue
            if last >= done["card"] and (found := expand_card(text, last)):
                done["card"] = found[0]
                if 16 <= len(found[1]) <= 19 and luhn(found[1]):
                    spans["card"].append((last, found[0]))
            if last >= done["ip"] and (ip := expand_ip(text, last)):
                done["ip"] = ip[0]
                if ip[1]:
                    spans["ip"].append((last, ip[0]))
            seen_digit = run_end(text, last, DIGITS)
        elif what == "@":
            if span := expand_email(text, last, done["email"]):
                done["email"] = span[1]
                spans["email"].append(span)
        elif what == "+":
            if last >= done["phone"] and (phone := expand_phone(text, last)):
                done["phone"] = phone[0]
                if 8 <= phone[1] <= 15:
                    spans["phone"].append((last, phone[0]))
        elif last >= done[what] and (last + 1 == size or text[last - size] not in ALNUM):
            expand = {"secret": expand_secret, "account": expand_account, "login": expand_login}[what]
            if span := expand(text, last + 1):
                done[what] = span[1]
                spans[what].append(span)
    return spans


def written(spans: dict[str, list[tuple[int, int]]], kinds: Sequence[str]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in spans[kind])


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with [KIND] for each span; of overlapping spans the one that starts first, then the longest, names the whole stretch."""
    parts, at = [], 0
    for start, end, kind in sorted(((s, e, k) for k, found in spans.items() for s, e in found), key=lambda x: (x[0], -x[1])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, redacted string"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = True) -> DataFrame:
    """The id, then the columns of SCHEMA for each row; narrow, without a shuffle. redacted is null unless asked for."""
    return _scan(df, columns(df, [id_col]), F.col(f"`{text_col}`"), redact)


def _scan(df: DataFrame, carry: Mapping[str, Column], text: Column, redact: bool) -> DataFrame:
    def worker():
        anchors = automaton()

        def one(text: str | None) -> tuple:
            spans = find(text or "", anchors)
            return (*(len(spans[k]) for k in BASE_KINDS), written(spans, BASE_KINDS), written(spans, KINDS), redacted(text, spans) if redact and text is not None else None)

        return lambda texts: list(zip(*map(one, texts.to_pylist()), strict=True)) if len(texts) else [[]] * 7

    return annotate(df, carry, text, worker, SCHEMA)


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """df with the spans in its text replaced; length_col, where given, is set to the new length."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    found = _scan(df, {"__row": row}, F.col(f"`{text_col}`"), True).withColumnRenamed("redacted", "__redacted").select("__row.*", "__redacted")
    new = {text_col: F.col("__redacted")} | ({length_col: F.length("__redacted").cast(df.schema[length_col].dataType)} if length_col else {})
    return found.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()

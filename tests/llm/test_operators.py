"""The training-data operators against brute-force versions, and their defined results in odd cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from provena.llm import chat, decontaminate, language_model, near_dup, packing, pii, quality_model, quality_rules, sharding, url_filter

DOCS = "doc_id long, text string, source string"
LONG = " ".join(f"w{(k * k * 31 + 7 * k) % 99_991}" for k in range(20_000))
#: Nulls in every column, empty and very long texts, repeated rows, ties.
ODD = [(1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (4, "one two", "b"), (4, "one two", "b"), (5, LONG, "a"), (None, "some words of a row that has no id at all", "c"), (6, "ONE two", "b")]
#: Columns whose names clash with those that operators make.
CLASH = "doc_id long, text string, source string, id long, key string, cls long, kept boolean, row string, score double, path string, block long, node long, length int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 7, "k", 1, None, "r", 0.5, "p", 3, 4, 9) for r in ODD], CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng, n):
    return [rng.choice(["the", "of", "and", "river", "stone", "Paris", "blue", "seven"]) + str(rng.randint(0, 400)) for _ in range(n)]


# URL filters


def test_urls_against_brute_force(spark):
    rng = random.Random(1)
    hosts = ["a.net", "net", "x.example.net", "example.net", "Example.COM", "b.example.com", "k.org", "netx", "a.net:80", ""]
    paths = ["", "/", "/en/", "/en/1", "/de/x", "/fr/", "/login/", "/wp-admin/x", "/press/release/login/"]
    rows = [(k, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/en/', '#x', '?sessionid=4'])}") for k in range(400)] + [(900, None), (901, ""), (902, "no scheme/login/"), (None, "http://a.net/x"), (903, "http://a.net/x\ny")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["page_id"]].append(r)
    rules = [("example.com/de/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow"), ("net/", "block")]
    for page, url in rows:
        r = by[page][0]
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (m[1].translate(quality_model.FOLD), m[2]) if m else ("", "")
        rule = next(((n, a) for n, a in rules if (h := n.split("/")[0]) and (host == h or host.endswith(f".{h}")) and path.startswith(n[len(h) :])), None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        low = (url or "").lower()
        found = any(p in low for p in ("/login/", "/wp-admin/", "?sessionid=")) and "/press/release/" not in low
        assert r["verdict"] == (rule[1] if rule else "block" if found else "allow")


def test_urls_large_index_gives_the_same(spark):
    df = spark.createDataFrame([(k, f"http://h{k % 9}.example.{t}/{p}") for k, (t, p) in enumerate([("net", "en/1"), ("com", "de/"), ("org", "login/"), ("net", "")])] + [(9, None)], "page_id long, url string")
    a, b = url_filter.judge(df), url_filter.judge(df, inline_tokens=0)
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)
    assert url_filter.judge(df, host_rules=(), patterns=()).filter("verdict <> 'allow' or rule is not null").count() == 0
    assert url_filter.judge(df.limit(0)).count() == 0


# personal data


def base_spans(t):
    out = {k: [] for k in pii.BASE_KINDS}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out["card"].append(m.span())
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii_base_spans_against_patterns():
    anchors, rng = pii.automaton(), random.Random(2)
    for _ in range(8000):
        t = "".join(rng.choice("0123456789.@+- ()ab.%é1234") for _ in range(rng.randint(0, 45)))
        got = pii.find(t, anchors)
        assert {k: got[k] for k in pii.BASE_KINDS} == base_spans(t), t


def test_pii_more_kinds_and_redaction():
    anchors = pii.automaton()
    text = 'mail a.b@c.org, token = "9b0b3c6a43eb78aa", IBAN: DE44 5001 0517 5407 3249 31, see https://user:pw123@host/x; nothing tokenish'
    spans = pii.find(text, anchors)
    assert [text[s:e] for s, e in spans["secret"]] == ["9b0b3c6a43eb78aa"]
    assert [text[s:e] for s, e in spans["login"]] == ["user:pw123"]
    assert [text[s:e] for s, e in spans["account"]] == ["DE44 5001 0517 5407 3249 31"]
    clean = pii.redacted(text, spans)
    assert "a.b@c.org" not in clean and "9b0b" not in clean and "[EMAIL]" in clean
    assert not any(pii.find("A clean text. The token of love, password of old; account of the year 2020.", anchors).values())


@pytest.mark.parametrize(("text", "kind", "found"), [
    ("Account No: 12345678.", "account", "12345678"), ("Social Security Number: 123-45-6789", "account", "123-45-6789"), ("Passport Number: 123456789", "account", "123456789"),
    ("iBan: GB29 NWBK 6016 1331 9268 19 and more", "account", "GB29 NWBK 6016 1331 9268 19"), ("IBAN NL91 ABNA 0417 1643 00", "account", "NL91 ABNA 0417 1643 00"), ("NUMÉRO DE COMPTE: 0012 3456 78", "account", "0012 3456 78"),
    ("Api_Key=abcd1234efgh", "secret", "abcd1234efgh"), ("Access_Key= 'abcd1234efgh'", "secret", "abcd1234efgh"), ("HTTP://me:pw@host", "login", "me:pw"), ("İ Passwd: s3cret99", "secret", "s3cret99"),
])
def test_pii_cues_in_any_spelling(text, kind, found):
    assert [text[s:e] for s, e in pii.find(text, pii.automaton())[kind]] == [found]


def test_pii_cue_kinds_against_patterns():
    """The added kinds by regular expressions: cue, sign, value."""
    rng, anchors = random.Random(23), pii.automaton()
    cues = [*pii.ACCOUNT_CUES, *pii.SECRET_CUES]
    value = {"account": r"[A-Za-z0-9]+(?:[ -][A-Za-z0-9]+)*", "secret": r"[A-Za-z0-9._\-+/=]+"}
    for _ in range(3000):
        cue = rng.choice(cues)
        kind = "account" if cue in pii.ACCOUNT_CUES else "secret"
        shown = "".join(rng.choice([c, c.upper()]) for c in cue)
        own = "".join(rng.choice("0123456789abX") for _ in range(rng.randint(0, 14)))
        text = f"{rng.choice(['', 'see ', 'x'])}{shown}{rng.choice([':', ': ', ' : '])}{own}{rng.choice(['', ', then', '; 5'])}"
        m = re.search(rf"(?<![A-Za-z0-9])(?i:{re.escape(cue)}) ?[:] ?({value[kind]})", text)
        digits = sum(c in pii.DIGITS for c in m[1]) if m else 0
        good = m and (digits >= 6 if kind == "account" else digits and len(m[1]) >= 8)
        assert pii.find(text, anchors)[kind] == ([m.span(1)] if good else []), text


def test_pii_odd_rows(odd, empty):
    got = pii.scan(odd)
    assert got.count() == len(ODD) and got.filter("spans <> '' and text is null").count() == 0 if "text" in got.columns else True
    assert got.filter("doc_id = 1").first()["redacted"] is None
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == len(ODD)
    assert pii.scan(empty).count() == 0


# language model


def test_language_model_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(words(rng, rng.randint(0, 60))), "s") for k in range(60)] + [(100, None, "s"), (101, "", "s"), (102, "Été là-bas 😀", "s"), (None, "no id here", "s")]
    got = {r["doc_id"]: r for r in language_model.score(spark.createDataFrame(rows, DOCS), block_bytes=2000).collect()}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows}
    token = lambda t: [*(t or "").encode().lower().split(), b"\xfe"]
    count = collections.Counter(w for i, t, _ in rows if not held[i] for w in token(t))
    total, kinds = sum(count.values()), len(count)
    seen = collections.defaultdict(collections.Counter)
    pad = lambda t: b"\xff" * 3 + (t or "").encode() + b"\xfe"
    for i, t, _ in rows:
        if not held[i]:
            x = pad(t)
            for k in range(3, len(x)):
                for o in range(4):
                    seen[x[k - o : k]][x[k]] += 1
    for i, t, _ in rows:
        r, ws = got[i], token(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(count[w] > 0 for w in ws), total, held[i])
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws), abs=1e-8)
        x, score = pad(t), 0.0
        for k in range(3, len(x)):
            gone = set()
            for o in (3, 2, 1, 0):
                after = seen.get(x[k - o : k])
                if not after:
                    continue
                live = {s: n for s, n in after.items() if s not in gone}
                if live:
                    whole = sum(live.values()) + len(live)
                    if x[k] in live:
                        score += math.log10(live[x[k]] / whole)
                        break
                    score += math.log10(len(live) / whole)
                gone = set(after)
            else:
                score -= math.log10(256 - len(gone))
        assert r["score"] == pytest.approx(score, abs=1e-6)


def test_language_model_odd_rows(odd, empty):
    assert language_model.score(odd).count() == len(ODD)
    assert language_model.score(empty).count() == 0


# quality classifier


def test_classifier_learns_and_is_held_out(spark):
    rng = random.Random(4)
    good = [(k, " ".join(words(rng, 40)), "s") for k in range(200)]
    bad = [(1000 + k, " ".join([rng.choice(["spam", "buy", "now"])] * 40), "s") for k in range(100)]
    docs = spark.createDataFrame([*good, *bad, (5000, "", "s"), (None, "x", "s")], DOCS)
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _, _ in [*good, *bad]] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_model.score_documents(docs, labels).collect()}
    assert len(got) == 302
    held = [r for i, r in got.items() if i is not None and i < 5000 and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] < 1000) for r in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_ftrl_against_brute_force():
    """Updates coordinate by coordinate, over dictionaries."""
    rng, model = random.Random(24), quality_model.Ftrl(6)
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    weight = lambda i: 0.0 if abs(z[i]) <= model.l1 else -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)
    for _ in range(300):
        found, label = [rng.randrange(64) for _ in range(rng.randint(0, 12))], rng.choice([0.0, 1.0])
        x = {i: k * quality_model.SCALE / len(found) for i, k in collections.Counter(found).items()} | {64: 1.0}
        total = sum(weight(i) * v for i, v in x.items())
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
        assert quality_model.score(np.array(found, np.int64), model.weights()) == pytest.approx(p, abs=1e-5)
        for i, v in x.items():
            g = (p - label) * v
            w = weight(i)
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha * w
            n[i] += g * g
        model.learn(np.array(found, np.int64), label)
    assert model.weights() == pytest.approx([weight(i) for i in range(65)], abs=1e-5)


def test_features_read_whole_words():
    make = quality_model.Features()
    long = "x" * 64
    assert make.of(f"{long}a")[0] != make.of(f"{long}b")[0] and make.of("_abc")[0] != make.of("_abd")[0] and make.of("$$$$")[0] != make.of("$$$")[0]


def test_classifier_without_labels(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_model.score_documents(odd, none).collect()} == {0.5}
    assert quality_model.score_documents(empty, none).count() == 0


# quality rules


def brute_rules(t):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    n = len(ws)
    count = collections.Counter(tuple(ws[k : k + 8]) for k in range(n - 7))
    in_ = {k + j for k in range(n - 7) if count[tuple(ws[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(in_)


def test_rules_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        part = words(rng, rng.randint(0, 14))
        t = "".join(w + rng.choice([" ", "\n", "\t", " ", "  ", "#"]) for w in part * rng.randint(1, 3) + words(rng, rng.randint(0, 20)))
        assert quality_rules.base_counts(t, t.encode()) == brute_rules(t)


def test_rules_bands(spark):
    rng = random.Random(6)
    prose = " ".join(words(rng, 500))
    noise = "".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") + (" " if rng.random() < 0.02 else "") for _ in range(6000))
    same = "\n".join(f"line {k % 3} of nothing new here" for k in range(300))
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame([(1, prose, ""), (2, noise, ""), (3, same, ""), (4, "short text", "")], DOCS)).collect()}
    assert [got[k]["kept"] for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert not got[2]["base_failed"] and got[3]["base_failed"] and got[4]["base_failed"]


def test_rules_bands_against_brute_force(spark):
    import zstandard

    rng, packer = random.Random(22), zstandard.ZstdCompressor(level=3)
    texts = ["\n".join(" | ".join(words(rng, rng.randint(1, 9))) if k % 11 == 0 else " ".join(words(rng, rng.randint(5, 60))) for _ in range(rng.randint(1, 30))) for k in range(600)]
    bands = tuple(quality_rules.stated(b) for b in (((0, 1.0, 2.4), (2000, 1.9, 2.6)), ((0, 1.2, 2.5), (2000, 1.8, 2.2))))
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame([(k, t, "") for k, t in enumerate(texts)], DOCS), bands=bands).collect()}
    size = lambda n: min(int(2 * math.log2(max(n, 1))), 63)
    inside = lambda raw, b: b[0][size(len(raw))] <= len(raw) / len(packer.compress(raw)) <= b[1][size(len(raw))]
    for k, t in enumerate(texts):
        raw = t.encode()
        chunks = [raw[a : a + 4096] for a in range(0, len(raw), 4096)]
        odd_ones = sum(not inside(c, bands[1]) for c in chunks) if len(chunks) > 1 else 0
        n = brute_rules(t)
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        r = got[k]
        assert (r["base_failed"], r["n_chunks"], r["n_odd_chunks"], r["kept"]) == (failed, len(chunks), odd_ones, not failed and inside(raw, bands[0]) and odd_ones <= 0.34 * len(chunks))
    assert 50 < sum(r["kept"] for r in got.values()) < 550
    # fitted limits: quartiles of the documents themselves
    measured = quality_rules.measure(spark.createDataFrame([(k, t, "") for k, t in enumerate(texts)], DOCS), {}, F.col("text"))
    low, high = quality_rules.fit(measured, 1.0, 1.0, 20)[0]
    by = collections.defaultdict(list)
    for k, t in enumerate(texts):
        if not got[k]["base_failed"]:
            by[size(len(t.encode()))].append(got[k]["zstd_ratio"])
    for at, held in by.items():
        if len(held) >= 20:
            q = np.quantile(held, [0.25, 0.5, 0.75], method="inverted_cdf")
            assert (low[at], high[at]) == pytest.approx((q[1] - q[2] + q[0], q[1] + q[2] - q[0]))


def test_rules_odd_rows(odd, empty):
    assert quality_rules.judge(odd).count() == len(ODD)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() >= 1
    assert quality_rules.judge(empty).count() == 0


# packing


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def ids_of(own, texts):
    ids, ends = own.of(pa.array(texts, pa.string()), 0)
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def test_word_ids_are_the_tokenizers(tokenizer_path):
    own, rng = packing.WordIds(tokenizer_path), random.Random(7)
    odd_signs = "שּׁאİ*#)>abAB.,;:!?'sétÉİΣß0%␟ \n\t ́ǅﬁ\x1c\x85　"
    texts = ["".join(rng.choice(odd_signs) for _ in range(rng.randint(0, 50))) for _ in range(3000)] + ["It's. don't, I'LL! <|endoftext|>. x<|endoftext|>y", "ΑΣ. ΣΑΣ, İ."]
    texts += ["&&& %%%, a&&& &&&", "%%% a, a %%%"]  # marks that are also words
    for mine, theirs in zip(ids_of(own, texts), own.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine == [*theirs.ids, 0]


def test_packing_round_trip(spark, tokenizer_path):
    rng = random.Random(8)
    rows = [(k, " ".join(words(rng, rng.randint(0, 300))), "s") for k in range(80)] + [(500, LONG, "s"), (501, None, "s"), (502, "", "s")]
    pieces = packing.tokenize(spark.createDataFrame(rows, DOCS), tokenizer_path)
    got = packing.pack(pieces, per_partition=40).collect()
    own = packing.WordIds(tokenizer_path)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, t, _ in rows:
        ids = ids_of(own, [t])[0]
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert [x for r in parts for x in r["ids"]] == ids
        assert [(r["piece"], r["start"], r["length"]) for r in parts] == [(k, a, len(ids[a : a + 2048])) for k, a in enumerate(range(0, len(ids), 2048))]
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in parts)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1].tolist()] and sum(n for _, n in held) <= 2048
    assert len(bins) <= 1.03 * packing.lower_bound(np.array([r["length"] for r in got])) + 1


def test_lower_bound_is_one():
    rng = np.random.default_rng(9)
    for _ in range(300):
        lengths = rng.integers(1, 21, rng.integers(1, 8))
        best = min(_bins(p, 20) for p in _orders(lengths.tolist()))
        assert packing.lower_bound(lengths, 20) <= best <= len(packing.best_fit(lengths, 20)[2])


def _orders(items):
    import itertools

    return itertools.permutations(items)


def _bins(order, size):
    n, room = 1, size
    for x in order:
        if x > room:
            n, room = n + 1, size
        room -= x
    return n


def test_packing_odd_rows(odd, empty, tokenizer_path):
    got = packing.pack(packing.tokenize(odd, tokenizer_path, with_ids=False))
    assert got.filter("piece = 0").count() == len(ODD)
    assert packing.pack(packing.tokenize(empty, tokenizer_path, with_ids=False)).count() == 0


# near-duplicates


def brute_components(rows, similarity=75):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
                    root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(rows)]


def near_copies(rng, n, edits):
    base = words(rng, 80)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = words(rng, 1)[0]
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("leaf", [32, 4])
def test_near_duplicates_against_brute_force(spark, leaf):
    rng = random.Random(10)
    texts = near_copies(rng, 60, 3) + near_copies(rng, 12, 2) + [" ".join(words(rng, rng.randint(1, 90))) for _ in range(40)] + ["a b", "A  b", "a b c", "same text of more than five words here"] * 2 + [None, "", " "]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), leaf=leaf).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_components(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_a_long_template(spark):
    # any two documents share the template (J = 96/136 = 0.71); those of a pair four more words (100/132 = 0.757)
    rng = random.Random(20)
    template = words(rng, 100)
    rows = []
    for k in range(1200):
        own = [f"p{k}x{j}" for j in range(4)]
        rows += [(2 * k + side, " ".join([*template, *own, *(f"q{k}s{side}x{j}" for j in range(16))])) for side in (0, 1)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(i, i - i % 2) for i in range(2400)]


def test_near_duplicates_of_large_mixed_nodes(spark):
    # blocks of a few texts, and nodes that must branch
    rng = random.Random(21)
    base, line = words(rng, 60), words(rng, 40)
    texts = near_copies(rng, 120, 6) + [" ".join(base[: rng.randint(20, 60)] + words(rng, rng.randint(0, 30))) for _ in range(100)] + [" ".join([*line, *words(rng, 30)]) for _ in range(150)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(brute_components(rows))
    for options in ({"leaf": 4, "block": 900}, {"leaf": 4, "branch": 20, "trees": 16}):
        got = near_dup.near_duplicates(docs, **options).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == whole


def test_keep_one_of_rows_that_share_an_id(spark):
    rows = [(3, "one two three four five six seven", 1), (7, "one two three four five six seven", 2), (7, "a text of its own, with other words than that", 3), (7, "a text of its own, with other words than that", 4), (None, "third text, which has no id and stands here twice", 5), (None, "third text, which has no id and stands here twice", 6), (8, None, 7), (8, None, 8)]
    kept = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept) == {(3, rows[0][1]): 1, (7, rows[2][1]): 1, (None, rows[4][1]): 1, (8, None): 2}


def test_near_duplicates_odd_rows(odd, empty):
    got = near_dup.near_duplicates(odd)
    assert got.count() == len(ODD)
    assert got.filter("doc_id = 6").first()["component_id"] == 4  # A-Z only differ in case
    assert got.filter("doc_id is null").first()["kept"]
    assert near_dup.keep_one(odd).columns == odd.columns
    assert near_dup.near_duplicates(empty).count() == 0


# sharding


def test_sharding_limits_and_prefixes(spark):
    rng = random.Random(11)
    rows = [(k, "x" * rng.randint(0, 400), "s") for k in range(600)] + [(7, "y" * 100, "s")] * 200 + [(900, "z" * 5000, "s"), (901, None, "s"), (None, "n", "s")]
    got = sharding.shard(spark.createDataFrame(rows, DOCS), limit=2000, step=2).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
    assert all(size[r["shard"]] == r["shard_bytes"] and len(r["shard"]) == r["depth"] for r in got)
    assert {r["shard"] for r in got if r["shard_bytes"] > 2000} == {r["shard"] for r in got if r["doc_id"] == 900 and r["oversize"]}
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    # a bucket splits only if it was too large
    for name in names:
        if name:
            assert sum(n for k, n in size.items() if k.startswith(name[:-1])) > 2000


def test_sharding_against_a_rebuild(spark):
    """A directory that splits one bucket after the other, from the rows' own bits."""
    rng = random.Random(25)
    rows = [(k, "x" * rng.randint(0, 300), "s") for k in range(500)]
    got = {r["doc_id"]: r for r in sharding.shard(spark.createDataFrame(rows, DOCS), limit=3000).collect()}
    # the first 32 bits come from the key alone, and distinct keys part within them here
    code = {k: f"{int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16):032b}" for k, _, _ in rows}
    todo, shard = [("", rows)], {}
    while todo:
        name, held = todo.pop()
        if len(held) <= 1 or sum(len(t) for _, t, _ in held) <= 3000:
            shard |= {k: name for k, _, _ in held}
        else:
            todo += [(name + bit, [r for r in held if code[r[0]][len(name)] == bit]) for bit in "01"]
    assert {k: r["shard"] for k, r in got.items()} == shard


def test_sharding_odd_rows(odd, empty):
    assert sharding.shard(odd).count() == len(ODD)
    assert sharding.shard(empty).count() == 0


# decontamination


ITEM = "Tom Baker bought 12 apples at 3 dollars each and gave Anna half of the 12 apples before the long walk home"


def test_decontamination_finds_copies_and_new_parameters(spark):
    rng = random.Random(12)
    wrap = lambda t: f"{' '.join(words(rng, 50))} {t} {' '.join(words(rng, 50))}"
    rows = [
        (1, wrap(ITEM), ""), (2, wrap("Tom Smith bought 45 apples at 7 euros each and gave Lena half of the 45 apples before the long walk home"), ""),
        (3, wrap("Tom Smith bought 45 apples at 7 euros each and gave Lena half of the 46 apples before the long walk home"), ""), (4, wrap(""), ""), (5, None, ""), (None, wrap(ITEM.upper()), ""), (6, wrap(" ".join(ITEM.split()[:8])), ""),
    ]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "two words")], "item_id long, text string")
    got = {r["doc_id"]: list(r["item_ids"]) for r in decontaminate.matches(docs, bench).collect()}
    # 3 breaks the binding of 12, so it isn't the same question
    assert got[1] == [10] and got[2] == [10] and got[3] == [] and got[4] == [] and got[5] == [] and got[6] == []
    joined = {r["doc_id"]: list(r["item_ids"]) for r in decontaminate.matches(docs, bench, max_broadcast=0).collect()}
    assert joined == got
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns


def found_items(spark, rows, bench):
    """Contaminating items by document; the broadcast and the joined way must agree."""
    docs, items = spark.createDataFrame([(i, t, "") for i, t in rows], DOCS), spark.createDataFrame(bench, "item_id long, text string")
    one, two = ({r["doc_id"]: list(r["item_ids"]) for r in decontaminate.matches(docs, items, max_broadcast=n).collect()} for n in (decontaminate.MAX_BROADCAST, 0))
    assert one == two
    return one


def test_decontamination_joins_the_parts_of_a_passage(spark):
    plain = lambda tag, n: [f"{tag}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n)]
    item, long = plain("w", 39), plain("l", 130)
    twice = [*plain("n", 10), "12", *plain("o", 14), "12", *plain("p", 10)]
    wrap = lambda ws: " ".join([*plain("x", 20), *ws, *plain("y", 20)])
    rows = [(1, wrap(item[:19] + item[20:])), (2, wrap([*item[:13], "extra", *item[13:26], "more", *item[26:]])), (3, wrap(long[30:90])), (4, wrap([*twice[:25], "13", *twice[26:]])), (5, wrap(item[:9])), (6, wrap(long[:12]))]
    assert found_items(spark, rows, [(1, " ".join(item)), (2, " ".join(long)), (3, " ".join(twice))]) == {1: [1], 2: [1], 3: [2], 4: [3], 5: [], 6: []}


def test_decontamination_finds_names_in_any_place_and_case(spark):
    ask = "{} has {} apples. {} has {} apples. {} gives {} {} apples. How many apples does {} have?"
    item = ask.format("Tom", 5, "Mary", 7, "Tom", "Mary", 2, "Tom")
    rows = [(1, ask.format("Jim", 8, "Lucy", 9, "Jim", "Lucy", 4, "Jim")), (2, item.lower()), (3, ITEM.upper()), (4, "Some other text about apples. It has no question in it, and many more words than the item has.")]
    assert found_items(spark, rows, [(1, item), (2, ITEM)]) == {1: [1], 2: [1], 3: [2], 4: []}


def test_decontamination_hits_against_brute_force():
    """Window meetings by comparing template tokens one by one, in every place and both forms."""
    rng = random.Random(26)
    token = lambda: rng.choice(["the", "of", "Ann", "Bob", "12", "7", "kg", "hours", "river.", "stone", "two", "Blue", "and,\n"])
    item_texts = [" ".join(token() for _ in range(rng.randint(1, 14))) for _ in range(12)] + ["", None]
    texts = [" ".join(token() for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None]
    items = decontaminate.Items(item_texts, 4)
    parts = items.make.of(pa.array(texts, pa.string()))
    name = items.make.slots[1]
    forms = lambda p, t: {int(p.template[t])} | ({name} if p.either[t] else set())
    want = set()
    for d in range(len(texts)):
        doc = parts.text(d)
        for k, (own, size) in enumerate(items.parts):
            for at in range(len(doc) - size + 1) if size else ():
                for place in range(len(own) - size + 1):
                    # in documents words of two forms are all plain or all names
                    for named in (False, True):
                        if all((name if named and doc.either[at + j] else int(doc.template[at + j])) in forms(own, place + j) for j in range(size)):
                            want.add((d, k, at, place))
    assert {tuple(h) for h in items.hits(parts).tolist()} == want and len(want) > 100


def test_decontamination_recall_of_new_parameters(spark):
    """Questions with other names, numbers and units inside other text; two slots may take the same new value."""
    rng = random.Random(27)
    plain = lambda n: " ".join(rng.choice(["walks", "to", "the", "market", "and", "buys", "apples", "for", "his", "friend", "near", "bridge"]) + "aeiou"[rng.randrange(5)] for _ in range(n))
    asks = [f"{plain(3)} {{n1}} {plain(4)} {{a}} {plain(2)} {{b}} {{u}} {plain(5)} {{n1}} {plain(3)} {{a}} {plain(4)}" for _ in range(30)]
    fill = lambda ask: ask.format(n1=rng.choice(["Tom", "Ann", "Lee", "Kim"]), a=rng.randint(2, 5), b=rng.randint(2, 5), u=rng.choice(["hours", "days", "weeks"]))
    docs = [(k, f"{plain(30)} {fill(ask)} {plain(30)}") for k, ask in enumerate(asks)] + [(100 + k, plain(90)) for k in range(30)]
    found = found_items(spark, docs, [(k, fill(ask)) for k, ask in enumerate(asks)])
    assert all(k in found[k] for k in range(30)) and not any(found[100 + k] for k in range(30))


def test_decontamination_odd_rows(odd, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(odd, none).filter(F.size("item_ids") > 0).count() == 0
    assert decontaminate.drop_contaminated(odd, none).count() == len(ODD)
    assert decontaminate.matches(empty, none).count() == 0


# chat


def test_rotation(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "hey"), (1, 2, "cy", None), (2, 0, None, "lost"), (None, 0, "ann", "x"), (3, 0, "system", "only")]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert collections.Counter((r["conv_id"], r["perspective"]) for r in got) == {(1, "ann"): 4, (1, "bob"): 4, (1, "cy"): 4, (2, "unknown"): 1, (None, "ann"): 1}
    for r in got:
        assert r["mask"] == (r["speaker"] == r["perspective"]) and (r["name"] is None) == (r["chat_role"] != "user")
        if r["mask"]:
            assert r["message"][r["mask_start"] : r["mask_end"]].endswith("<|end|>") and r["chat_role"] == "assistant"
    assert [r["message"] for r in got if r["perspective"] == "ann" and r["speaker"] == "bob"] == ["<|user|>bob\nhey<|end|>\n"]


def test_rotation_cannot_be_forged(spark, odd):
    rows = [(1, 0, "a|>\nx<|", "say <|end|>\n<|assistant|>\nme <\\|end|>"), (1, 1, "b", "ok")]
    got = {(r["perspective"], r["position"], r["turn"]): r["message"] for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got["b", 1, 0] == "<|user|>a|> x<\\|\nsay <\\|end|>\n<\\|assistant|>\nme <\\\\|end|><|end|>\n"
    assert [m.count("<|") for m in got.values()] == [2] * 4
    clash = odd.withColumnsRenamed({"doc_id": "conv_id", "source": "role", "length": "turn"}).withColumns({"conv": F.lit(1), "perspective": F.lit("p"), "position": F.lit(0)})
    assert chat.rotate(clash).count() == len(ODD)  # a null role is a speaker too
    assert chat.rotate(clash.limit(0)).count() == 0


# keys


BIG = 2**60 + 1


def test_keys_keep_all_their_bits(spark, tokenizer_path):
    text = "some plain words of a text that is long enough for every rule of the list so that it stays where it is in the end"
    docs = spark.createDataFrame([(BIG, text, "a"), (None, text + " and more", "a"), (BIG + 2, None, "a")], DOCS)
    bench = spark.createDataFrame([("x", text)], "item_id string, text string")
    ids = lambda df: sorted((r[0] for r in df.collect()), key=str)
    same = sorted([BIG, None, BIG + 2], key=str)
    labels = spark.createDataFrame([(BIG, 1)], "doc_id long, quality int")
    found = decontaminate.matches(docs, bench)
    assert {r["doc_id"]: r["item_ids"] for r in found.collect()}[BIG] == ["x"]
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.matches(docs, bench, max_broadcast=0).collect()}[BIG] == ["x"]
    pieces = packing.tokenize(docs, tokenizer_path)
    for made in (found, pii.scan(docs), quality_rules.judge(docs), language_model.score(docs), quality_model.score_documents(docs, labels), near_dup.near_duplicates(docs), pieces, packing.pack(pieces), sharding.shard(docs), pii.redact(docs)):
        assert ids(made) == same, made.columns
    assert {r["component_id"] for r in near_dup.near_duplicates(docs.filter("doc_id is null or text is not null")).collect()} == {BIG}
    for kept in (decontaminate.drop_contaminated(docs, bench), near_dup.keep_one(docs), quality_rules.keep_good(docs)):
        assert set(ids(kept)) <= set(same)
    assert ids(near_dup.keep_one(docs)) == sorted([BIG, BIG + 2], key=str)
    named = docs.withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    for made in (decontaminate.matches(named, bench), pii.scan(named), quality_rules.judge(named), language_model.score(named), near_dup.near_duplicates(named), packing.pack(packing.tokenize(named, tokenizer_path))):
        assert ids(made) == sorted([f"k{BIG}", None, f"k{BIG + 2}"], key=str)


# the pipeline


def test_pipeline_against_brute_force(spark, tmp_path, tokenizer_path):
    import corpus_pipeline

    rng = random.Random(13)
    bench = " ".join(words(rng, 30))
    texts = [" ".join(words(rng, 60)) for _ in range(20)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, texts[3]), (101, texts[4] + " extra"), (102, "too short"), (103, f"{texts[5]} {bench} {' '.join(words(rng, 40))}"), (104, " ".join(words(rng, 60)) + " write to a.b@c.org soon")]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({r["doc_id"] for r in got}) == [*range(20), 104]
    own = packing.WordIds(tokenizer_path)
    for i, t in [*enumerate(texts), (104, rows[-1][1].replace("a.b@c.org", "[EMAIL]"))]:
        ids = ids_of(own, [t])[0]
        assert [x for r in got if r["doc_id"] == i for x in r["ids"]] == ids
        assert [r["ids_crc32"] for r in got if r["doc_id"] == i] == [zlib.crc32(np.array(ids, "<u4").tobytes())]


def test_digest_of_nothing():
    assert pii.digest("") == hashlib.sha256(b"").hexdigest()


# bounds that were missing


def test_one_word_sentences_make_few_windows(spark):
    """Windows over words of two forms stay linear in the item, and are counted as they are before a broadcast."""
    item = " ".join(f"W{chr(97 + k % 26)}{chr(97 + k // 26)}." for k in range(200))
    frame = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    n = decontaminate.count_windows(frame.filter("text is not null"), 8)
    assert n == len(decontaminate.Items([item], 8, frozenset()).codes) <= 18 * 193
    assert [len(decontaminate.choices(k)) for k in range(5)] == [1, 2, 4, 8, 10]
    docs = spark.createDataFrame([(1, f"see {item}", "s"), (2, "nothing here", "s")], DOCS)
    for most in (n, n - 1):
        got = {r["doc_id"]: r["item_ids"] for r in decontaminate.matches(docs, frame, max_broadcast=most).collect()}
        assert got == {1: [1], 2: []}


def test_bands_follow_the_corpus_by_one_rule(spark):
    """Quartiles over all lengths together, against the reference; a tenth of the corpus places them nearly where the whole does."""
    rng = random.Random(21)
    texts = [" ".join(words(rng, rng.randint(25, 900))) for _ in range(600)] + ["same line again and again\n" * 80]
    measured = quality_rules.measure(spark.createDataFrame([(k, t, "") for k, t in enumerate(texts)], DOCS), {"k": F.col("doc_id")}, F.col("text")).persist()
    low, high = quality_rules.place(measured, 1.0, 2.0)[0]
    centres, spreads = quality_rules.stated(quality_rules.SHAPE)
    at = lambda n: min(int(2 * math.log2(max(n, 1))), 63)
    rows = [r for r in measured.collect() if not (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])]
    z = sorted((r["zstd_ratio"] - centres[at(r["n_bytes"])]) / spreads[at(r["n_bytes"])] for r in rows)
    q = [z[math.ceil(len(z) * p) - 1] for p in (0.25, 0.5, 0.75)]
    outer = quality_rules.stated(quality_rules.DOCUMENT_BANDS)
    for k in range(64):
        assert math.isclose(low[k], max(outer[0][k], centres[k] + spreads[k] * (q[1] - max(q[2] - q[0], 1))), rel_tol=1e-9)
        assert math.isclose(high[k], min(outer[1][k], centres[k] + spreads[k] * (q[1] + 2 * max(q[2] - q[0], 1))), rel_tol=1e-9)
    part = quality_rules.place(measured.filter("k % 10 = 3"), 1.0, 2.0)[0]
    assert all(abs(a - b) < 0.3 * b for a, b in zip(part[1], high, strict=True) if b)
    assert quality_rules.place(measured.limit(0)) == (outer, quality_rules.stated(quality_rules.CHUNK_BANDS))


def test_urls_clashing_columns(spark):
    """Columns whose names clash with those that the filter makes are ignored, ids of any type pass."""
    rows = [("a", "http://x.net/login/", "h", "p", "r", [1], True), (None, None, "h", "p", "r", None, None), ("b", "https://K.org/fr/", "h", "p", "r", [2], False)]
    df = spark.createDataFrame(rows, "page_id string, url string, host string, path string, rule string, tokens array<int>, matched boolean")
    for inline in (512, 0):
        got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(df, inline_tokens=inline).collect()}
        assert got == {"a": ("x.net", "/login/", "net/", "block", None), None: ("", "", None, "allow", None), "b": ("k.org", "/fr/", "org/fr/", "allow", None)}


def test_url_patterns_decide(spark, tmp_path):
    import duckdb

    from provena.llm import queries

    urls = ["http://blog.a.example.com/fr/1", "http://blog.a.example.com/en/1?page=2&x", "https://m.b.example.net/", "https://m.b.example.netx/", "http://a.org/es/17", "http://a.org/en/#top", "http://a.org/#topx", "HTTP://BLOG.z.org", None, ""]
    spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.url_patterns(spark, str(tmp_path))
    base = duckdb.connect()
    base.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = base.sql(queries.oracle_sql()["url_patterns"])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)
    assert len({r["pattern"] for r in got.collect()}) == 7


def test_pipeline_of_odd_and_empty_documents(spark, tmp_path, tokenizer_path):
    import corpus_pipeline

    rng = random.Random(14)
    columns_ = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, kept boolean, seq string"
    good = " ".join(words(rng, 80))
    rows = [(1, good), (1, good), (2, None), (3, ""), (None, " ".join(words(rng, 70))), (4, " \n\t "), (5, " ".join(words(rng, 6000)))]
    for name, data in (("odd", rows), ("empty", [])):
        spark.createDataFrame([(i, t, None, "s", None, "k", 0.5, True, "q") for i, t in data], columns_).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r["doc_id"] for r in got} == {1, None, 5} and len([r for r in got if r["doc_id"] == 1]) == 1
    assert sum(r["length"] for r in got if r["doc_id"] == 5) == len(ids_of(packing.WordIds(tokenizer_path), [rows[-1][1]])[0])
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0

"""Vector codes, divergence audit and suffix dedup against brute force and the SQL, and their defined results in odd cases."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from provena.llm import divergence, queries, suffix_dedup, vector_codes

# vector codes

VECTORS = "vec_id long, embedding array<float>, label int"
CLASHING = "vec_id long, embedding array<float>, label int, id long, vec string, codes string, error double, of_label int, lower string"


def lloyd(rows, parts=4, entries=256, rounds=4):
    """(codes, errors, books) by exhaustive search in integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    step = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * step : (p + 1) * step]
    first = [v for _, v in sorted(kept)[:entries]]
    books = [[list(cut(v, p)) for v in first] for p in range(parts)]
    for turn in range(rounds + 1):
        near = [[min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, v in kept]
        if turn == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v), n in zip(kept, near, strict=True) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return {i: ("".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n)) for (i, _), n in zip(kept, near, strict=True)}, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize("entries", [256, 7])
def test_vector_codes_against_brute_force(spark, entries):
    rng = random.Random(entries)
    # few distinct values: many ties
    rows = [(k, [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5 + rng.choice([0, 0.003])]) for _ in range(8)]) for k in range(120)]
    rows += [(200, None), (201, [0.0, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 8), (203, [math.inf] * 8), (204, []), (205, rows[3][1])]
    labels = {i: None if i % 5 == 0 else i % 3 for i, _ in rows}
    df = spark.createDataFrame([(i, v, labels[i], 1, "v", "c", 0.5, 2, "l") for i, v in rows], CLASHING)
    got = {r["vec_id"]: r for r in vector_codes.report(df, entries=entries).collect()}
    want, digest = lloyd([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], entries=entries)
    sums = collections.Counter()
    for i, (_, e) in want.items():
        sums[labels[i]] += e
    assert {i: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for i, r in got.items()} == {i: (c, e, sums[labels[i]], digest) for i, (c, e) in want.items()}


def test_vector_codes_odd(spark):
    none = vector_codes.report(spark.createDataFrame([], VECTORS))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0
    assert vector_codes.report(spark.createDataFrame([(1, None, 1), (2, [], None)], VECTORS)).count() == 0
    # repeated ids and a null id; fewer vectors than entries
    rows = [(1, [0.0, 1.0, 2.0, 3.0], 1), (1, [0.5, 1.0, 2.0, 3.0], 1), (None, [9.0, 9.0, 9.0, 9.0], None), (None, [9.0, 9.0, 9.0, 9.0], None)]
    got = vector_codes.report(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=str) == [(1, "00000000", 0), (1, "01000000", 0), (None, "02020202", 0), (None, "02020202", 0)]
    for bad in ([(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)], [(1, [1.0] * 6, 0)], [(1, [1e30] * 4, 0)]):
        with pytest.raises(Exception, match="components"):
            vector_codes.report(spark.createDataFrame(bad, VECTORS)).collect()


def test_bounds_prune_and_stay_true():
    """Bounds kept from round to round leave most pairs out, and none that could be nearest."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 30, (200, 4)) for c in range(0, 8000, 400)]).astype(np.int64)
    book = x[::37].copy()
    state, before = (None, None, None), None
    for _ in range(5):
        part = vector_codes.Part(book, before)
        code, best, upper, lower = part.assign(x, *state)
        all_ = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (code == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
        assert (upper**2 >= best).all() and (lower**2 <= all_).all()
        low, unit = vector_codes.packed(lower)
        assert (low * unit[:, None] <= lower).all()
        state, before = (code, upper, low * unit[:, None]), book
        book = np.array([x[code == k].sum(axis=0) // max((code == k).sum(), 1) if (code == k).any() else book[k] for k in range(len(book))])
    part = vector_codes.Part(book, before)
    left = ~((np.maximum(state[2] - part.moved, 0) > (state[1] + part.moved[state[0]])[:, None]) | (part.half[state[0]] > (state[1] + part.moved[state[0]])[:, None]))
    assert left.mean() < 0.2


# divergence audit

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(rows, top=200):
    seen = [(lang or "", source or "", TERM.findall((text or "").translate(FOLD))) for text, lang, source in rows]
    out = set()
    for lang in {s[0] for s in seen}:
        docs, groups = collections.Counter(t for s in seen if s[0] == lang for t in set(s[2])), collections.defaultdict(collections.Counter)
        kept = {t for t, n in docs.items() if n >= 3}
        whole = collections.Counter()
        for s in seen:
            if s[0] == lang:
                mine = [t for t in s[2] if t in kept]
                groups[s[1]].update(mine)
                whole.update(mine)
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        for source, c in groups.items():
            parts = {"pair": [(-sum(f(p(c, t), p(d, t)) for t in kept), o.encode(), o) for o, d in groups.items() if o != source], "term": [(-f(p(c, t), p(whole, t)), t.encode(), t) for t in kept if c[t] and p(c, t) > p(whole, t)]}
            for part, found in parts.items():
                out |= {(lang, source, part, item, -v, k + 1) for k, (v, _, item) in enumerate(sorted(found)) if part == "pair" or k < top}
    return out


def audit_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Ka", "re", "Öl", "ß", "漢", "zu") for b in ("na", "LO", "mé", "", "t")]
    rows = [(" ".join(rng.choice(vocabulary[: rng.randint(2, 30)]) + rng.choice(["", ".", "1", "_"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None])) for _ in range(120)]
    return rows + [(None, "en", "a"), ("", "xx", "one"), ("word word word", "xx", "two"), (rows[5][0],) + rows[5][1:], ("loner loner", "yy", "s")]


@pytest.mark.parametrize("top", [200, 3])
def test_divergence_against_brute_force(spark, top):
    rows = audit_rows(top)
    df = spark.createDataFrame([(*r, k, "t", 1, 0.5) for k, r in enumerate(rows)], "text string, lang string, source string, doc_id long, term string, n int, p double")
    got = divergence.audit(df, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == audited(rows, top)


def test_divergence_odd(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(none).count() == 0
    long = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(200_000))
    rows = [(long, "en", "a"), (long, "en", "b"), (long, "en", "b"), ("x" * 100_000, "en", "b")]
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string")).collect()} == audited(rows)
    assert [tuple(r) for r in spark.sql(f"SELECT {divergence.probability('9100000000L', '20000000000L', '5L')} AS a, {divergence.probability('0L', '0L', '3L')} AS b").collect()] == [(1 + 10**9 * 9_100_000_001 // 20_000_000_005, 1 + 10**9 // 3)]


# suffix dedup

DOCS = "doc_id long, text string"


def repeats(rows):
    """(id, bytes, removed, spans, digest of the rest) of each row by every 50-byte string."""
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49) if i is not None else ():
            s = b[k : k + 50]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, b in data:
        gone = [False] * len(b)
        for k in range(len(b) - 49) if i is not None else ():
            if least[b[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the ", "river ", "of ", "ñandú ", "漢字", "aa", "a", "\n", "stone, "])
    shared = ["".join(word() for _ in range(rng.randint(3, 60))) for _ in range(8)] + ["a" * 130, "ab" * 60, "x" * 49, "y" * 50]
    rows = []
    for k in range(90):
        text = "".join(rng.choice(shared)[rng.randint(0, 9) :] if rng.random() < 0.3 else word() for _ in range(rng.randint(0, 25)))
        rows.append((rng.randint(0, 70) if k % 7 else k * 10**15, text))
    return rows + [rows[3], (5, rows[8][1]), (None, rows[8][1]), (None, None), (91, None), (92, ""), (93, rows[8][1] * 3), (-4, rows[9][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup_against_brute_force(spark, seed):
    rows = passages(seed)
    df = spark.createDataFrame([(*r, 1, "s", 2, 3) for r in rows], "doc_id long, text string, id long, segment string, batch int, kind int")
    got = suffix_dedup.report(df, batches=(4, 1, 5)[seed - 1])
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == repeats(rows)


def test_suffix_dedup_odd(spark):
    assert suffix_dedup.report(spark.createDataFrame([], DOCS)).count() == 0
    long = "".join(chr(97 + (k * k * 31 + 7 * k) % 9_973 % 26) for k in range(300_000))
    rows = [(1, long), (2, "q" + long[100_000:220_000] + "z"), (3, long[131_040:131_100]), (3, long[131_040:131_100])]
    assert sorted(map(tuple, suffix_dedup.report(spark.createDataFrame(rows, DOCS)).collect()), key=str) == repeats(rows)
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows[:2], DOCS)).collect()}
    assert found[2]["spans"] == [[1, 120_001]] and bytes(found[2]["kept"]) == b"qz" and bytes(found[1]["kept"]).decode() == long


def test_levels_merge_geometrically(spark, tmp_path):
    family = suffix_dedup.Family(spark, str(tmp_path), "suffix")
    held = []
    for k in range(6):
        rows = spark.createDataFrame([(k, f"{k} " * 100)], "id long, text string").selectExpr(f"{k} AS segment", "id", "text")
        family.add(suffix_dedup.asks(rows, None, "suffix", 4))
        held.append(sorted(family.levels))
    assert held == [[0], [1], [0, 1], [2], [0, 2], [1, 2]]


def test_runs_cover_all_strings():
    """Every string of 50 bytes lies in one run, and equal strings pick equal suffixes at equal places."""
    texts = ["abc" * 40, "", "é" * 40, "no", "The quick brown fox jumps over the lazy dog, twice and more.", "xx The quick brown fox jumps over the lazy dog, twice and more."]
    runs = suffix_dedup.Runs(pa.array(texts + [None]))
    run, start = runs.strings(np.arange(len(runs.at)))
    sizes = [len(t.encode()) for t in texts]
    assert len(start) == len(set(start.tolist())) == sum(max(0, n - 49) for n in sizes)
    seen = {}
    for r, s in zip(run, start, strict=True):
        assert seen.setdefault(runs.data[s : s + 50], runs.at[r] - s) == runs.at[r] - s


# the SQL says the same


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_divergence_audit", "op13_suffix_dedup"])
def test_sql(spark, tmp_path, name):
    rng = random.Random(8)
    texts = [r for r in passages(9) if r[0] is not None]
    spark.createDataFrame([(i, t, *rng.choice([("en", "a"), ("en", "b"), (None, "a"), ("de", None)])) for i, t in texts], "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, None if k == 5 else [rng.uniform(-1, 1) for _ in range(8)], rng.choice([None, 1, 2])) for k in range(300)], VECTORS).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    base = duckdb.connect()
    for table in ("documents", "embeddings"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    want = base.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)

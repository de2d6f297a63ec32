"""Source divergence audit: how far each source of a language is from the others, and its most over-used terms.

Terms are runs of ASCII letters and non-ASCII code points, A-Z lower-cased. A language keeps the V terms
that occur in at least `least` of its documents. A (lang, source) group and a language give each kept term
the whole number p = 1 + floor(SCALE * (count + 1) / (N + V)), N the count's sum over kept terms, and the
divergence of p from q at a term is f = floor((p - q)^2 / q). All arithmetic is in integers.

* Counts: one narrow pass that numbers the terms of a slice and adds up counts and documents before
  anything is shuffled.
* `pairs`: every ordered pair of sources of a language, f summed over all kept terms. Terms that one side
  lacks depend only on the other's count, so they are summed from histograms of counts; postings (term to
  source and count), joined with themselves on the term, correct for the terms that both have, both
  directions in one row. What is shuffled is aggregated by pair.
* `terms`: the `top` terms that a group uses more than its language does (p > q). The terms of a group lie
  in buckets by count; the largest p and the least q in a bucket bound f there. Buckets are evaluated best
  bound first, in waves of growing size, until the bounds of all unseen ones are strictly below the value
  at rank `top`, so ties at that rank are complete. Each wave keeps `top` rows of a group in each task
  before it shuffles.

Groups, histograms and buckets are written tables, so Spark knows their sizes when it chooses to broadcast
them; a language or source that holds much of the rows meets joins of plain tables, which Spark can split.

Defined results: null text, lang and source are empty strings; a group without kept terms takes part in
pairs; a language of one source has no pairs; where V is 0 every value of a pair is 0; an empty table
gives an empty result; extra columns are ignored. Counts of up to about 10^18 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provena.llm.common import Words, cut, drop, slices

SCALE = 1_000_000_000
#: A language keeps the terms of so many of its documents.
LEAST = 3
TOP = 200
#: A task's sums leave it when they are so many rows.
HELD = 400_000
#: The first wave evaluates buckets of about `top` terms a group, each next one so many times more.
GROWTH = 8
_byte = np.arange(256, dtype=np.uint8)
#: Each byte of a text as a byte of a term: A-Z lower-cased, other ASCII but a-z blank. Bytes of other code points stay.
FOLDED = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, np.where((_byte >= 0x80) | ((_byte >= 97) & (_byte <= 122)), _byte, 32)).astype(np.uint8)


def folded(texts: pa.Array) -> pa.Array:
    """The texts with everything but terms blank. Lengths in bytes stay, so offsets do."""
    texts = pc.fill_null(texts, "")
    if texts.offset or texts.type != pa.string():
        texts = pa.array(texts.to_pylist(), pa.string())
    _, offsets, data = texts.buffers()
    made = FOLDED[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(made.tobytes()))


def slice_counts(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.Table:
    """lang, source, term, n (occurrences), docs (documents with the term) of a slice; a null term, 0 and 0 for each group."""
    words = Words(folded(texts))
    groups = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    keys = pc.binary_join_element_wise(lang, source, pc.cast(pc.utf8_length(lang), pa.string()), "\x00").dictionary_encode()
    group = keys.indices.to_numpy()
    sample = np.unique(group, return_index=True)[1]
    size = max(len(words.vocabulary), 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    in_doc, n = np.unique(doc * size + words.codes, return_counts=True)
    slot, where = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    of = groups.take(pa.array(np.concatenate([sample[slot // size], sample]) if len(sample) else sample, pa.int64()))
    term = words.vocabulary.take(pa.array(np.concatenate([slot % size, np.zeros(len(sample), np.int64)]), pa.int64(), mask=np.arange(len(slot) + len(sample)) >= len(slot)))
    n, docs = np.bincount(where, weights=n, minlength=len(slot)).astype(np.int64), np.bincount(where, minlength=len(slot)).astype(np.int64)
    none = np.zeros(len(sample), np.int64)
    return pa.table({"lang": of.field(0), "source": of.field(1), "term": term.cast(pa.string()), "n": np.concatenate([n, none]), "docs": np.concatenate([docs, none])})


def counts(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of each term of each group; a null term for every group."""
    texts = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def added() -> pa.Table:
            found = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            return found.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for at, size in slices(batch.column(2)):
                part = batch.slice(at, size)
                held.append(slice_counts(part.column(0), part.column(1), part.column(2)))
                if sum(t.num_rows for t in held) > 2 * HELD:
                    held = [added()]
                    if held[0].num_rows > HELD:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from added().to_batches()

    found = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def divergence(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def probability(n: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(SCALE * (n + 1) / (total + terms)): longs where the product fits, else decimals."""
    return f"1 + CASE WHEN {n} < 9000000000 THEN ({n} + 1) * {SCALE}L div ({total} + {terms}) ELSE (CAST({n} + 1 AS DECIMAL(19, 0)) * {SCALE}L) div CAST({total} + {terms} AS DECIMAL(19, 0)) END"


class Tables:
    """What both parts of the report read: written tables.

    langs: lang, v (kept terms), lang_n. groups: lang, source, v, lang_n, group_n, p0 (of a term that it lacks; null where v is 0).
    entries: lang, source, term, n, p0, p, q of the kept terms that a group has.
    """

    def __init__(self, df: DataFrame, text_col: str, lang_col: str, source_col: str, least: int):
        counted = cut(counts(df, text_col, lang_col, source_col))
        kept = cut(counted.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("term_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs"))
        langs = cut(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("term_n").alias("lang_n")))
        known = cut(counted.filter("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]))
        of_group = known.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        all_groups = counted.filter("term IS NULL").select("lang", "source")
        groups = all_groups.join(langs, "lang", "left").join(of_group, ["lang", "source"], "left").fillna(0, ["v", "lang_n", "group_n"])
        self.groups = cut(groups.withColumn("p0", F.expr(f"CASE WHEN v > 0 THEN {probability('0L', 'group_n', 'v')} END")))
        self.entries = cut(
            known.join(self.groups, ["lang", "source"])
            .select("lang", "source", "term", "n", "p0", F.expr(probability("n", "group_n", "v")).alias("p"), F.expr(probability("term_n", "lang_n", "v")).alias("q"))
        )
        drop(counted, kept, langs, known)

    def drop(self) -> None:
        drop(self.groups, self.entries)


def pairs(tables: Tables) -> DataFrame:
    """lang, source, item, value: the divergence of each group from every other source of its language, over all kept terms."""
    groups, entries = tables.groups, tables.entries
    ordered = groups.alias("a").join(groups.alias("b"), F.expr("a.lang = b.lang AND a.source <> b.source"))
    base = ordered.selectExpr("a.lang", "a.source", "b.source AS item", f"coalesce(a.v * ({divergence('a.p0', 'b.p0')}), 0L) AS value")
    # a term that only one side has: its count decides, so terms of a count are summed at once
    histogram = entries.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("terms"))
    sided = histogram.alias("a").join(groups.alias("b"), F.expr("a.lang = b.lang AND a.source <> b.source"))
    one = sided.select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("one"), F.col("b.source").alias("two"),
        F.expr(f"a.terms * (({divergence('a.p', 'b.p0')}) - ({divergence('a.p0', 'b.p0')}))").alias("there"),
        F.expr(f"a.terms * (({divergence('b.p0', 'a.p')}) - ({divergence('b.p0', 'a.p0')}))").alias("back"),
    )
    # a term that both have: the sum above takes it for two terms of one side each
    met = entries.alias("a").join(entries.alias("b"), F.expr("a.lang = b.lang AND a.term = b.term AND a.source < b.source"))
    both = met.select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("one"), F.col("b.source").alias("two"),
        *[
            F.expr(f"({divergence(f'{x}.p', f'{y}.p')}) - ({divergence(f'{x}.p', f'{y}.p0')}) - ({divergence(f'{x}.p0', f'{y}.p')}) + ({divergence(f'{x}.p0', f'{y}.p0')})").alias(name)
            for name, x, y in (("there", "a", "b"), ("back", "b", "a"))
        ],
    )
    sums = [d.groupBy("lang", "one", "two").agg(F.sum("there").alias("there"), F.sum("back").alias("back")) for d in (one, both)]
    changes = [s.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item"), F.col("there").alias("value")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"), F.col("back").alias("value")))).alias("x")).select("lang", "x.*") for s in sums]
    return base.unionByName(changes[0]).unionByName(changes[1]).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def ranked(df: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    df = df.withColumn("rank", F.row_number().over(order))
    return df if top is None else df.filter(F.col("rank") <= top)


def terms(tables: Tables, top: int) -> DataFrame:
    """lang, source, item, value: of each group the `top` terms with p > q, by value and term."""
    # counts up to 64 by themselves, larger ones by their leading four bits
    bits = F.length(F.bin("n")).cast("int") - 4
    entries = tables.entries.withColumn("bucket", F.when(F.col("n") <= 64, F.col("n")).otherwise(F.expr("-64L") - bits.cast("long") * 16 - F.expr("shiftright(n, length(bin(n)) - 4)")))
    buckets = entries.groupBy("lang", "source", "bucket").agg(F.count(F.lit(1)).alias("size"), F.max("p").alias("p"), F.min("q").alias("q"))
    bounded = cut(buckets.filter("p > q").withColumn("bound", F.expr(divergence("p", "q"))))
    seen, best, limit = None, None, top
    while True:
        left = bounded if seen is None else bounded.join(seen, ["lang", "source", "bucket"], "left_anti")
        if best is not None:
            kth = best.filter(F.col("rank") == top).select("lang", "source", F.col("value").alias("kth"))
            # strictly below: a bound that equals the value at rank `top` can hold a tie
            left = left.join(kth, ["lang", "source"], "left").filter(F.col("kth").isNull() | (F.col("bound") >= F.col("kth"))).drop("kth")
        order = Window.partitionBy("lang", "source").orderBy(F.col("bound").desc(), "bucket")
        before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        wave = cut(left.withColumn("before", before).filter(F.col("before") < limit).select("lang", "source", "bucket"))
        if wave.isEmpty():
            drop(wave)
            break
        met = entries.join(wave, ["lang", "source", "bucket"]).filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(divergence("p", "q")).alias("value"))
        found = cut(ranked(met if best is None else met.unionByName(best.drop("rank")), top))
        both = wave if seen is None else cut(seen.unionByName(wave))
        drop(best, *([seen, wave] if seen is not None else []))
        seen, best, limit = both, found, limit * GROWTH
    drop(bounded, seen)
    return best if best is not None else ranked(entries.limit(0).select("lang", "source", F.col("term").alias("item"), F.col("p").alias("value")))


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    tables = Tables(df, text_col, lang_col, source_col, least)
    kinds = (("pair", cut(ranked(pairs(tables)))), ("term", terms(tables, top)))
    tables.drop()
    first, second = (d.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for part, d in kinds)
    return first.unionByName(second)

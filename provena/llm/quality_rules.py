"""Quality rules: repetition rules and compression bands over whole texts.

`judge(df)` returns a row for each row of the input: the id, counts, ratios and the verdict.
The compression bands are the method: the zstandard ratio (raw bytes / compressed bytes) of the
whole text and of its fixed-size chunks must lie between limits that depend on the length. A high
ratio marks repetitive text, a low one incompressible text (encoded data).

The limits follow the corpus by one rule for every size of it. How a ratio grows with the length and
how far ratios of a length spread is a fixed reference (`SHAPE`, `CHUNK_SHAPE`: parameters). Each ratio is
measured against it, as (ratio - centre) / spread, and the quartiles of these numbers over all documents
(or chunks) that pass the base rules, of all lengths together, place the bands: from the median `LOW_FENCE`
interquartile ranges down and `HIGH_FENCE` up, an interquartile range counting as 1 (the reference's own) at
least. A band never leaves the stated outer limits DOCUMENT_BANDS and CHUNK_BANDS. No class of lengths is
fitted by itself, so a small corpus is judged like a large one of its kind. The quartiles are mergeable
sketches over all rows; the driver gets three numbers for documents and three for chunks. `fit` finds
limits class by class, for those who want to give them as `bands`.

Defined results: a null text counts as empty; an empty text has no words, ratio 0 and is rejected
by the base rules; repeated rows and ties are judged row by row; a null id is carried through; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import annotate, columns, cut, drop, mix64, strings

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: (length in bytes from which it holds, lowest ratio, highest ratio). Short texts hold less to repeat, so their ratio spreads less.
DOCUMENT_BANDS = ((0, 0.0, 2.6), (100, 0.7, 2.6), (400, 1.2, 3.2), (1_000, 1.4, 4.2), (4_000, 1.5, 5.5), (20_000, 1.6, 8.0))
CHUNK_BANDS = ((0, 0.0, 2.6), (100, 0.7, 2.6), (400, 1.1, 3.4), (1_000, 1.3, 6.0), (4_000, 1.4, 9.0))
#: (length in bytes from which it holds, usual ratio, interquartile range) of prose: the reference that ratios are measured against.
SHAPE = (
    (0, 0.5, 0.1), (32, 0.82, 0.09), (64, 1.05, 0.1), (90, 1.19, 0.11), (128, 1.32, 0.125), (181, 1.45, 0.12), (256, 1.53, 0.102), (362, 1.6, 0.102), (512, 1.69, 0.08), (724, 1.82, 0.09), (1_024, 1.92, 0.067), (1_448, 1.995, 0.058),
    (2_048, 2.07, 0.053), (2_896, 2.125, 0.048), (4_096, 2.184, 0.043), (5_792, 2.23, 0.055), (8_192, 2.27, 0.06), (11_585, 2.32, 0.08), (16_384, 2.39, 0.082), (23_170, 2.4, 0.09), (32_768, 2.42, 0.15), (65_536, 2.5, 0.2), (131_072, 2.57, 0.25),
)
#: Of full chunks, which hold other text before and after; shorter ones are as documents.
CHUNK_SHAPE = (*[x for x in SHAPE if x[0] < 4_096], (4_096, 2.157, 0.036))
CHUNK_BYTES = 4_096
#: Share of the chunks that may lie outside their band.
CHUNK_SHARE = 0.34
CLASSES = 64
LOW_FENCE, HIGH_FENCE, MIN_ROWS = 4.0, 2.25, 200
Bands = tuple[Sequence[float], Sequence[float]]


def band(bands: Sequence[tuple[int, float, float]], n: float) -> tuple[float, float]:
    low, high = bands[0][1:]
    for start, least, most in bands:
        if n >= start:
            low, high = least, most
    return low, high


def length_class(n_bytes: Column) -> Column:
    """Half octaves: from 0 for one byte."""
    return F.least(F.floor(F.log2(F.greatest(n_bytes, F.lit(1))) * 2), F.lit(CLASSES - 1)).cast("int")


def stated(bands: Sequence[tuple[int, float, float]]) -> Bands:
    """Limits for each length class; a class takes those of its shortest texts."""
    both = [band(bands, 2 ** (k / 2)) for k in range(CLASSES)]
    return [x[0] for x in both], [x[1] for x in both]


def fitted(ratios: DataFrame, bands: Sequence[tuple[int, float, float]], low_fence: float, high_fence: float, min_rows: int) -> Bands:
    """Limits for each length class from rows (size, ratio)."""
    low, high = map(list, stated(bands))
    by = ratios.groupBy(length_class(F.col("size")).alias("at")).agg(F.count("*").alias("n"), F.percentile_approx("ratio", [0.25, 0.5, 0.75], 1000).alias("q"))
    for r in by.filter(F.col("n") >= min_rows).collect():
        spread = r["q"][2] - r["q"][0]
        low[r["at"]], high[r["at"]] = r["q"][1] - low_fence * spread, r["q"][1] + high_fence * spread
    return low, high


def placed(ratios: DataFrame, bands: Sequence[tuple[int, float, float]], shape: Sequence[tuple[int, float, float]], low_fence: float, high_fence: float) -> Bands:
    """Limits for each length class from rows (size, ratio) of all lengths, measured against the shape, within `bands`."""
    centres, spreads = stated(shape)
    at = lambda held: F.element_at(F.array(*map(F.lit, held)), length_class(F.col("size")) + 1)
    quartiles = ratios.agg(F.percentile_approx((F.col("ratio") - at(centres)) / at(spreads), [0.25, 0.5, 0.75], 10_000)).first()[0]
    outer = stated(bands)
    if quartiles is None:
        return outer
    first, middle, third = quartiles
    width = max(third - first, 1.0)
    low = [max(least, c + s * (middle - low_fence * width)) for least, c, s in zip(outer[0], centres, spreads, strict=True)]
    high = [min(most, c + s * (middle + high_fence * width)) for most, c, s in zip(outer[1], centres, spreads, strict=True)]
    return low, high


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words which the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seen = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    hashed = mix64(seen + np.uint64(0x9E3779B97F4A7C15))
    codes = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + n]
    order = np.argsort(mix64(codes), kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice[:n])
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str, raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = raw.split()
    lines = Counter(line for line in text.split("\n") if line.strip(BLANKS))
    return len(words), len(text) - sum(map(text.count, BLANKS)), len(raw) - len(raw.translate(None, SYMBOLS)), sum(lines.values()) - len(lines), repeated_words(words)


def ratio(raw: bytes, packer: zstandard.ZstdCompressor) -> float:
    return len(raw) / len(packer.compress(raw)) if raw else 0.0


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, zstd_ratio double, chunk_bytes array<int>, chunk_ratios array<double>"


def measure(df: DataFrame, carry: Mapping[str, Column], text: Column, level: int = 3, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The columns in `carry`, then MEASURES for each row; narrow. A text of one chunk has no chunk ratios."""

    def worker():
        packer = zstandard.ZstdCompressor(level=level)

        def one(text: str) -> tuple:
            raw = text.encode()
            chunks = [raw[k : k + chunk_bytes] for k in range(0, len(raw), chunk_bytes)] if len(raw) > chunk_bytes else []
            return (*base_counts(text, raw), len(raw), ratio(raw, packer), [len(c) for c in chunks], [ratio(c, packer) for c in chunks])

        return lambda texts: list(zip(*map(one, strings(texts)), strict=True)) if len(texts) else [[]] * 9

    return annotate(df, carry, text, worker, MEASURES)


def good_ratios(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(size, ratio) of the documents that pass the base rules, and of their chunks."""
    good = measured.filter(~base_failed())
    chunks = good.select(F.explode(F.arrays_zip("chunk_bytes", "chunk_ratios")).alias("c")).select(F.col("c.chunk_bytes").alias("size"), F.col("c.chunk_ratios").alias("ratio"))
    return good.select(F.col("n_bytes").alias("size"), F.col("zstd_ratio").alias("ratio")), chunks


def fit(measured: DataFrame, low_fence: float = LOW_FENCE, high_fence: float = HIGH_FENCE, min_rows: int = MIN_ROWS) -> tuple[Bands, Bands]:
    """Bands of documents and of chunks class by class from measured rows, for use as `bands`; classes of fewer than min_rows keep the outer limits."""
    documents, chunks = good_ratios(measured)
    return fitted(documents, DOCUMENT_BANDS, low_fence, high_fence, min_rows), fitted(chunks, CHUNK_BANDS, low_fence, high_fence, min_rows)


def place(measured: DataFrame, low_fence: float = LOW_FENCE, high_fence: float = HIGH_FENCE) -> tuple[Bands, Bands]:
    """The bands that the documents and chunks of measured rows place; those that fail the base rules don't count."""
    documents, chunks = good_ratios(measured)
    return placed(documents, DOCUMENT_BANDS, SHAPE, low_fence, high_fence), placed(chunks, CHUNK_BANDS, CHUNK_SHAPE, low_fence, high_fence)


def inside(size: Column, value: Column, bands: Bands) -> Column:
    limit = lambda held: F.element_at(F.array(*map(F.lit, held)), length_class(size) + 1)
    return value.between(limit(bands[0]), limit(bands[1]))


def verdict(measured: DataFrame, bands: tuple[Bands, Bands], chunk_share: float = CHUNK_SHARE) -> DataFrame:
    """measured with base_failed, kept, n_chunks, n_odd_chunks."""
    n_chunks = F.when(F.col("n_bytes") > 0, F.greatest(F.size("chunk_ratios"), F.lit(1))).otherwise(0).cast("long")
    odd = F.size(F.filter(F.arrays_zip("chunk_bytes", "chunk_ratios"), lambda c: ~inside(c["chunk_bytes"], c["chunk_ratios"], bands[1]))).cast("long")
    known = measured.withColumns({"base_failed": base_failed(), "n_chunks": n_chunks, "n_odd_chunks": odd})
    fits = inside(F.col("n_bytes"), F.col("zstd_ratio"), bands[0]) & (F.col("n_odd_chunks") <= chunk_share * F.col("n_chunks"))
    return known.withColumn("kept", ~F.col("base_failed") & fits)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "zstd_ratio", "n_chunks", "n_odd_chunks")


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: tuple[Bands, Bands] | None = None, chunk_share: float = CHUNK_SHARE, **options) -> DataFrame:
    """The id and COUNTS for each row; no shuffle but of quartile sketches. bands: those of another corpus; else df places them.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated windows.
    kept: not base_failed, and the compression ratios lie in their bands.
    """
    measured = measure(df, columns(df, [id_col]), F.col(f"`{text_col}`"), **options)
    if bands is None:
        measured = cut(measured)  # numbers only
        bands = place(measured)
    return verdict(measured, bands, chunk_share).select(f"`{id_col}`", *COUNTS)


def keep_good(df: DataFrame, text_col: str = "text", bands: tuple[Bands, Bands] | None = None, chunk_share: float = CHUNK_SHARE, **options) -> DataFrame:
    """The rows of df that pass, with df's columns. Two passes over the texts, one to place the bands; rows aren't joined."""
    text = F.col(f"`{text_col}`")
    if bands is None:
        numbers = cut(measure(df, {}, text, **options))
        bands = place(numbers)
        drop(numbers)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return verdict(measure(df, {"__row": row}, text, **options), bands, chunk_share).filter("kept").select("__row.*")

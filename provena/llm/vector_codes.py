"""Vector code compression: product codes by Lloyd's method with Elkan's bounds.

A vector is scaled to integers (floor(scale * x)) and cut into equal consecutive parts; each part
position has a codebook of at most `entries` entries, which starts as that part of the vectors with
the smallest ids. A round assigns every part to its nearest entry (squared Euclidean distance, ties to
the lower index) and replaces each entry by the componentwise floor of its parts' mean; unused entries
stay. After the last round parts are assigned once more.

The state between rounds is a table in the shared folder: for each vector and part its entry, an upper
bound of the distance to it, and a lower bound of the distance to every entry. After a round the bounds
move by as much as the entries did. An entry is left out if its lower bound, or half its distance from
the part's own entry, is strictly above the upper bound; what is left is computed in integers, so ties
are decided exactly and the codes are those of an exhaustive search. Upper bounds are rounded up, lower
bounds down: they are kept in a byte each, as multiples of the part's largest bound / 255, so the state
is about one byte for each vector and entry whatever the number of rounds.

Only codebooks (parts * entries * width integers) and their sums pass through the driver. Sums are
added up in each task before they are shuffled.

Defined results: rows whose vector is null, empty, or holds null or non-finite components are dropped;
null ids come last in the order of ids, rows of one id follow the order of their components; a table
with fewer vectors than entries has as many entries as vectors; an empty table gives an empty result.
Vectors of different lengths, of a length that the parts don't divide, or with components so large that
a row's error would not fit into 64 bits raise ValueError. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena.llm.common import cut, drop

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows that a task looks at together.
ROWS = 2048
#: Pairs of a part and an entry whose distances are computed together.
PAIRS = 1 << 18
#: Bounds are relaxed by this share, which is far above the error of a double.
SLACK = 1e-9


def integers(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """id, label and the scaled vector of the rows that are kept."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vec")).filter((F.size("vec") > 0) & finite)
    return rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; checks lengths and sizes."""
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"vectors of {width} and of {lengths[lengths != width][0]} components")
    found = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)
    limit = int((2**62 / width) ** 0.5 / 2)
    if len(found) and (found.max() > limit or found.min() < -limit):
        raise ValueError(f"scaled components beyond {limit}")
    return found


def distances(x: np.ndarray, rows: np.ndarray, book: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of pairs (row of x, entry)."""
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), PAIRS):
        gap = x[rows[at : at + PAIRS]] - book[entries[at : at + PAIRS]]
        out[at : at + PAIRS] = np.einsum("ij,ij->i", gap, gap)
    return out


class Part:
    """One part position: its codebook, half distances between entries, and how far entries moved in the last round."""

    def __init__(self, book: np.ndarray, before: np.ndarray | None):
        self.book = book
        gaps = [((book - entry) ** 2).sum(axis=1) for entry in book]
        self.half = np.sqrt(np.array(gaps, np.float64)) / 2 * (1 - SLACK)
        self.moved = None if before is None else np.sqrt(((book - before) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)

    def assign(self, x: np.ndarray, code: np.ndarray | None, upper: np.ndarray | None, lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes, exact squared distances, upper and lower bounds of the rows of x, from those of the round before (None: of the first entry, unbounded)."""
        n, size = len(x), len(self.book)
        every = np.arange(n)
        if code is None:
            code, lower = np.zeros(n, np.int64), np.zeros((n, size))
            upper = np.full(n, np.inf)
        else:
            upper = upper + self.moved[code]
            lower = np.maximum(lower - self.moved, 0)
        best = distances(x, every, self.book, code)
        upper = np.minimum(upper, np.sqrt(best.astype(np.float64)) * (1 + SLACK))
        lower[every, code] = upper * (1 - 3 * SLACK)
        # strictly above: an entry at the same distance is computed
        open_ = ~((lower > upper[:, None]) | (self.half[code] > upper[:, None]))
        open_[every, code] = False
        rows, entries = np.nonzero(open_)
        found = distances(x, rows, self.book, entries)
        lower[rows, entries] = np.sqrt(found.astype(np.float64)) * (1 - SLACK)
        # nearest first, ties by index: the current entry takes part
        rows, entries, found = np.concatenate([rows, every]), np.concatenate([entries, code]), np.concatenate([found, best])
        order = np.lexsort((entries, found, rows))
        first = order[np.concatenate([[True], rows[order][1:] != rows[order][:-1]])] if n else order
        code, best = entries[first], found[first]
        return code, best, np.sqrt(best.astype(np.float64)) * (1 + SLACK), lower


def packed(lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds as bytes and their unit, rounded down."""
    unit = lower.max(axis=1, initial=0.0) / 255
    return np.floor(np.divide(lower, unit[:, None], out=np.zeros_like(lower), where=unit[:, None] > 0) * (1 - SLACK)).astype(np.uint8), unit


def assigned(rows: DataFrame, books: np.ndarray, before: np.ndarray | None, last: bool) -> DataFrame:
    """rows with codes, the error and the bounds for the books; before: the books that the rows' bounds are for."""
    parts, size, step = books.shape
    width = parts * step
    kinds = rows.schema
    schema = f"id {kinds['id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, " + ("codes binary, error long" if last else "vec array<bigint>, codes binary, error long, upper binary, unit binary, lower binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [Part(books[p], None if before is None else before[p]) for p in range(parts)]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n = batch.num_rows
                x = matrix(batch.column(2), width)
                if before is not None:
                    old = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(shape) for c, t, shape in (("codes", np.uint8, (n, parts)), ("upper", np.float64, (n, parts)), ("unit", np.float64, (n, parts)), ("lower", np.uint8, (n, parts, size)))}
                made = []
                for p, place in enumerate(places):
                    state = (None, None, None) if before is None else (old["codes"][:, p].astype(np.int64), old["upper"][:, p], old["lower"][:, p] * old["unit"][:, p, None])
                    made.append(place.assign(x[:, p * step : (p + 1) * step], *state))
                codes = np.stack([m[0] for m in made], axis=1).astype(np.uint8)
                rows_of = lambda a: pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())
                held = [batch.column(0), batch.column(1)] + ([] if last else [batch.column(2)]) + [rows_of(codes), pa.array(sum(m[1] for m in made))]
                if not last:
                    low = [packed(m[3]) for m in made]
                    held += [rows_of(np.stack([m[2] for m in made], axis=1)), rows_of(np.stack([u for _, u in low], axis=1)), rows_of(np.stack([b for b, _ in low], axis=1))]
                yield pa.RecordBatch.from_arrays(held, names=["id", "label", "codes", "error"] if last else ["id", "label", "vec", "codes", "error", "upper", "unit", "lower"])

    names = ["id", "label", "vec"] + ([] if before is None else ["codes", "upper", "unit", "lower"])
    return rows.select(*names).mapInArrow(run, schema)


def moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books after a round: floors of the means of the parts that have each entry."""
    parts, size, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * size, step), np.int64), np.zeros(parts * size, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), parts * step).reshape(-1, step)
                slots = (np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts) + np.arange(parts) * size).ravel()
                np.add.at(sums, slots, x)
                counts += np.bincount(slots, minlength=parts * size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *(pa.array(sums[used, k]) for k in range(step))], names=["slot", "n", *(f"s{k}" for k in range(step))])

    schema = "slot long, n long, " + ", ".join(f"s{k} long" for k in range(step))
    totals = state.select("vec", "codes").mapInArrow(run, schema).groupBy("slot").agg(*[F.sum(c).alias(c) for c in ["n", *(f"s{k}" for k in range(step))]])
    new = books.reshape(parts * size, step).copy()
    for slot, n, *sums in totals.collect():
        new[slot] = [s // n for s in sums]
    return new.reshape(books.shape)


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids; None for an empty table."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), F.col("vec")).select("vec").limit(entries).collect()
    if not first:
        return None
    width = len(first[0][0])
    if width % parts:
        raise ValueError(f"{parts} parts don't divide {width} components")
    return np.ascontiguousarray(matrix(pa.array([r[0] for r in first], pa.list_(pa.int64())), width).reshape(-1, parts, width // parts).transpose(1, 0, 2))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all integers in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(a row for each kept vector: id, label, codes as a byte for each part, error; the codebooks as [part, entry, position])."""
    if not 0 < entries <= 256:
        raise ValueError("an index takes a byte: 1 to 256 entries")
    rows = integers(df, id_col, vector_col, label_col, scale)
    books, before, state = first_books(rows, parts, entries), None, None
    if books is None:
        return rows.limit(0).select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    for _ in range(rounds):
        old, state = state, cut(assigned(state if state is not None else rows, books, before, last=False))
        drop(old)
        books, before = moved(state, books), books
    out = cut(assigned(state if state is not None else rows, books, before, last=True))
    drop(state)
    return out, books


def report(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **options) -> DataFrame:
    """id, code (two hex digits a part), error, label_error (the error summed over equal labels, nulls together), codebooks_sha256.

    The sums by label are a written table, so Spark knows its size: it broadcasts it where it is small and else
    splits a label that holds much of the rows, as neither side of the join is an aggregate.
    """
    coded, books = compress(df, id_col, vector_col, label_col, **options)
    sums = cut(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select(F.col("id").alias(id_col), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

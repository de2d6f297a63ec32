"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Texts reach Python workers in slices of at most so many bytes and rows (one row at least).
SLICE_BYTES, SLICE_ROWS = 4 << 20, 4096
#: Makes Spark remove a query's shuffle files as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="provena-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df as a table written to the shared folder and read back, so that later jobs neither recompute it nor depend on one executor.

    The shuffle files behind it go at once; the table itself goes with drop().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/provena/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    done = spark.read.schema(df.schema).parquet(path)
    done._provena_path = path
    for kept in _open:
        kept.append(done)
    return done


#: What cut() wrote inside of each open scratch().
_open: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """On leaving, removes all tables that cut() wrote inside: for callers that have written their result by then."""
    kept: list[DataFrame] = []
    _open.append(kept)
    try:
        yield
    finally:
        _open.remove(kept)
        drop(*kept)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(*tables: DataFrame | None) -> None:
    """Remove the files of tables that cut() wrote and nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_provena_path", None):
            remove(df.sparkSession, path)


def crc_bucket(column: Column, modulus: int = 5) -> Column:
    """crc32 of a key written as text, modulo a number; null for a null key."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, on uint64 arrays."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, number of rows) of slices that keep to SLICE_BYTES and SLICE_ROWS."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, len(texts)
    while at < n:
        held = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, held + SLICE_BYTES, side="right"))), at + SLICE_ROWS, n)
        yield at, end - at
        at = end


def annotate(df: DataFrame, carry: Mapping[str, Column], text: Column, worker: Callable[[], Callable[[pa.Array], object]], fields: str) -> DataFrame:
    """The columns in `carry`, then the `fields` (DDL) that worker()'s function makes of slices of the texts; narrow.

    The function gets an Arrow array of strings (with nulls) and returns a sequence for each field;
    or, to return another number of rows, a pair of the rows' places in the slice and such
    sequences. Carried columns pass as Arrow arrays, untouched: Python never sees their values, so
    a 64-bit key next to a null keeps all its bits.
    """
    picked = df.select(*[c.alias(f"in_{k}") for k, c in enumerate(carry.values())], text.cast("string").alias("in_text"))
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([*picked.schema.fields[:-1], *made.fields])
    kinds, n = list(to_arrow_schema(made)), len(carry)
    names = [*(f"in_{k}" for k in range(n)), *made.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = worker()
        for batch in batches:
            for at, size in slices(batch.column(n)):
                part = batch.slice(at, size)
                held, found = part.columns[:n], work(part.column(n))
                if isinstance(found, tuple):
                    places, found = found
                    held = [c.take(pa.array(places, pa.int64())) for c in held]
                yield pa.RecordBatch.from_arrays([*held, *(c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(found, kinds, strict=True))], names=names)

    out = picked.mapInArrow(run, schema)
    return out.select(*[F.col(f"in_{k}").alias(c) for k, c in enumerate(carry)], *made.names)


def columns(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(f"`{c}`") for c in dict.fromkeys(names)}


def strings(texts: pa.Array) -> list[str]:
    """The texts, empty where null."""
    return [t or "" for t in texts.to_pylist()]


class Words:
    """The words (runs of anything but ASCII white space) of a slice of texts, numbered.

    vocabulary: the distinct words; codes: the number of each word, text after text;
    starts: where each text's words start in codes, and the end.
    """

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        self.vocabulary, codes = coded.dictionary, coded.indices.to_numpy()
        offsets = offsets - offsets[0]
        # white space at the ends of a text leaves empty words
        empty = pc.index(self.vocabulary, pa.scalar("", self.vocabulary.type)).as_py() if len(self.vocabulary) else -1
        if empty >= 0:
            full = codes != empty
            self.codes, self.starts = codes[full], np.concatenate([[0], np.cumsum(full)])[offsets]
        else:
            self.codes, self.starts = codes, offsets.astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        import xxhash

        return np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary.cast(pa.binary()).to_pylist()), np.uint64, len(self.vocabulary))

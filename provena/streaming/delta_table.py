"""A keyed table that takes batches in proportion to their own size: hash buckets, delta files, merge on read.

Layout under one folder:

    buckets                       how many buckets there are
    base/bucket=<k>/upto=<n>/     the rows of bucket k with all batches up to n applied
    delta/batch=<n>/bucket=<k>/   of batch n the row that counts for each key

A row of the table gives way to a key's row of a batch if that is good, or if the row isn't good itself and the
other one is a listed failure. Over many batches that comes to: the last good row, else (if the table's row
isn't good) the last listed failure. So batches need no order among themselves when they are read, and a
batch is only written, never applied, until `compact` rewrites the buckets whose deltas have grown.

A folder counts once Spark has marked it complete. A batch that is written again (a replay after a crash)
finds itself complete and changes nothing; one that was cut off is written anew. `compact` writes the new
base of a bucket beside the old one; what it replaces is removed by the next compaction, so a reader that began
earlier still finds its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provena.schemas import ORDER, conform, last_wins, ordered

DONE = "_SUCCESS"
START = -1


@dataclass(frozen=True)
class Rule:
    """When a row of a batch counts: its status is `good`, or one of the `listed` failures and the table's row isn't good."""

    columns: tuple[str, ...]
    key: str = "source_id"
    good: str = "fetched"
    listed: tuple[str, ...] = ("failed", "skipped")

    def counts(self) -> Column:
        return F.col("status").isin(self.good, *self.listed)


class DeltaTable:
    def __init__(self, spark: SparkSession, path: str, rule: Rule, buckets: int = 16):
        self.spark, self.path, self.rule, self.default = spark, path.rstrip("/"), rule, buckets
        self.order = f"{ORDER} long"

    # files
    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def _values(self, path: str) -> list[int]:
        """The numbers in the names of the folders (name=number) under path."""
        fs, where = self._fs(path)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        return sorted(int(n.partition("=")[2]) for n in names if "=" in n)

    def _remove(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    @property
    def buckets(self) -> int:
        return (self._values(f"{self.path}/buckets") or [self.default])[0]

    def _schema(self, *more: str) -> str:
        return ", ".join([*(f"{c} string" for c in self.rule.columns), *more])

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # batches and bases
    def batches(self) -> list[int]:
        """The batches that are complete."""
        return [n for n in self._values(f"{self.path}/delta") if self._exists(f"{self.path}/delta/batch={n}/{DONE}")]

    def bases(self) -> dict[int, int]:
        """The batch up to which each bucket's base goes."""
        found = {}
        for k in self._values(f"{self.path}/base"):
            whole = [n for n in self._values(f"{self.path}/base/bucket={k}") if self._exists(f"{self.path}/base/bucket={k}/upto={n}/{DONE}")]
            if whole:
                found[k] = whole[-1]
        return found

    def create(self, rows: DataFrame) -> None:
        """The table's first rows. Does nothing where the table exists."""
        if self._values(f"{self.path}/buckets"):
            return
        rows = conform(ordered(rows), list(self.rule.columns)).withColumn("bucket", self._bucket(F.col(self.rule.key)))
        self._put(rows, START)
        fs, where = self._fs(f"{self.path}/buckets/n={self.default}")
        fs.mkdirs(where)

    def _put(self, rows: DataFrame, upto: int) -> None:
        """Rows (with their bucket) as the bases of their buckets: written beside the old ones, then moved into place."""
        rough = f"{self.path}/rough"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(rough)
        for k in self._values(rough):
            target = f"{self.path}/base/bucket={k}/upto={upto}"
            self._remove(target)
            fs, where = self._fs(target)
            fs.mkdirs(where.getParent())
            fs.rename(self._fs(f"{rough}/bucket={k}")[1], where)
            fs.create(self._fs(f"{target}/{DONE}")[1]).close()
        self._remove(rough)

    def append(self, batch: DataFrame, number: int) -> bool:
        """Write batch `number`; False where it is there already. Only the batch is read and written."""
        path = f"{self.path}/delta/batch={number}"
        if self._exists(f"{path}/{DONE}") or number <= max(self.bases().values(), default=START):
            return False
        rows = last_wins(conform(ordered(batch), list(self.rule.columns)), self.rule.key).filter(self.rule.counts())
        rows.select(*self.rule.columns, self._bucket(F.col(self.rule.key)).alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return True

    def _deltas(self, bases: dict[int, int]) -> DataFrame:
        """The rows of batches that the bases don't hold yet, with batch and bucket."""
        paths = [f"{self.path}/delta/batch={n}" for n in self.batches() if n > min(bases.values(), default=START)]
        if not paths:
            return self.spark.createDataFrame([], self._schema("batch int", "bucket int"))
        rows = self.spark.read.schema(self._schema("batch int", "bucket int")).option("basePath", f"{self.path}/delta").parquet(*paths)
        upto = F.element_at(F.create_map(*[x for k, n in bases.items() for x in (F.lit(k), F.lit(n))]), F.col("bucket")) if bases else F.lit(START)
        return rows.filter(F.col("batch") > F.coalesce(upto, F.lit(START)))

    def _base(self, bases: dict[int, int], only: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/base/bucket={k}/upto={n}" for k, n in bases.items() if only is None or k in only]
        if not paths:
            return self.spark.createDataFrame([], self._schema(self.order, "bucket int"))
        return self.spark.read.schema(self._schema(self.order, "bucket int", "upto int")).option("basePath", f"{self.path}/base").parquet(*paths).drop("upto")

    def _merged(self, base: DataFrame, deltas: DataFrame) -> DataFrame:
        rule, row = self.rule, F.struct(*self.rule.columns)
        good = F.col("status") == rule.good
        last = deltas.groupBy("bucket", F.col(rule.key).alias("_key")).agg(F.max_by(row, F.when(good, F.col("batch"))).alias("good"), F.max_by(row, F.when(~good, F.col("batch"))).alias("failed"))
        joined = base.join(last, (base["bucket"] == last["bucket"]) & (base[rule.key] == last["_key"]), "left").drop(last["bucket"])
        new = F.when(F.col("good").isNotNull(), F.col("good")).when(base["status"] != rule.good, F.col("failed"))
        return joined.select(*[F.coalesce(new[c], base[c]).alias(c) for c in rule.columns], base[ORDER].alias(ORDER), base["bucket"].alias("bucket"))

    def read(self) -> DataFrame:
        """The table with all complete batches applied, in no order (ORDER has that of the first rows)."""
        bases = self.bases()
        return self._merged(self._base(bases), self._deltas(bases)).drop("bucket")

    def compact(self, share: float = 0.25) -> list[int]:
        """Rewrite the buckets whose deltas have more rows than `share` of their base; the buckets rewritten."""
        bases = self.bases()
        grown = dict(self._deltas(bases).groupBy("bucket").count().collect())  # a row for each bucket
        size = dict(self._base(bases, list(grown)).groupBy("bucket").count().collect()) if grown else {}
        due = [k for k, n in grown.items() if n > share * size.get(k, 0) and k in bases]
        upto = max(self.batches(), default=START)
        if due:
            self._put(self._merged(self._base(bases, due), self._deltas(bases).filter(F.col("bucket").isin(due))), upto)
        for k, n in bases.items():
            # what the compaction before this one replaced
            for old in self._values(f"{self.path}/base/bucket={k}"):
                if old < n:
                    self._remove(f"{self.path}/base/bucket={k}/upto={old}")
        for n in self.batches():
            if n <= min(bases.values(), default=START):
                self._remove(f"{self.path}/delta/batch={n}")
        return sorted(due)

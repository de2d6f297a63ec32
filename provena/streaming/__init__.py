"""Incremental use: crawls that arrive in micro-batches, classified and turned into facts as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provena.operators import extract, quality
from provena.schemas import EVIDENCE, ORDER, strings
from provena.streaming.delta_table import DeltaTable, Rule


def read_evidence(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """A stream of evidence rows from Parquet files that arrive in a folder."""
    return spark.readStream.schema(strings(EVIDENCE)).option("maxFilesPerTrigger", max_files).parquet(path)


def facts_stream(evidence: DataFrame, sources: DataFrame, out: str, checkpoint: str, run_ts: str):
    """Facts of each micro-batch, appended to `out`; the batch number makes a repeated batch recognisable."""

    def each(batch: DataFrame, number: int) -> None:
        judged = quality.classify_evidence(sources, batch)
        found = extract.facts(sources, judged, run_ts).drop(ORDER)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return evidence.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def evidence_table(spark: SparkSession, path: str, buckets: int = 16) -> DeltaTable:
    """A table of evidence that takes retry crawls batch by batch, with the rule of source_map.merge_evidence."""
    return DeltaTable(spark, path, Rule(tuple(EVIDENCE), good="ok", listed=("failed", "empty", "playwright_required")), buckets)


def merge_stream(retries: DataFrame, table: DeltaTable, checkpoint: str, compact_every: int = 20):
    """Retry crawls merged into an evidence table. A micro-batch writes its own rows; every `compact_every` batches the buckets that have grown are rewritten."""

    def each(batch: DataFrame, number: int) -> None:
        held = DeltaTable(batch.sparkSession, table.path, table.rule, table.default)
        if held.append(batch, number) and (number + 1) % compact_every == 0:
            held.compact()

    return retries.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Exports: single CSV files with a byte-order mark, and the run's manifest. Inside the engine tables are Parquet."""

from __future__ import annotations

import csv
import json
import shutil
import subprocess
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from provena.sinks.csv_file import FORMAT, CsvFile

VERSION = "provena/0.1"


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """df as one CSV file with a header, in df's order, written by its tasks (see csv_file). The number of rows, counted on the way.

    The file replaces an older one only when it is complete, so a table may be written over its own source.
    """
    spark, seen = df.sparkSession, Observation()
    spark.dataSource.register(CsvFile)
    have = set(df.columns)
    rows = df.select(*[c for c in dict.fromkeys(columns) if c in have]) if have & set(columns) else df.select(F.lit("").alias("_"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.format(FORMAT).option("path", str(Path(path).absolute())).option("columns", json.dumps(list(columns))).mode("overwrite").save()
    return seen.get["rows"]


def back_up(path: str) -> None:
    """A copy with .bak beside a file that is about to be replaced."""
    if Path(path).exists():
        shutil.copy2(path, f"{path}.bak")


def commit() -> str:
    try:
        return subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=True).stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        return ""


def run_id(prefix: str = "pilot_validated") -> str:
    return f"{prefix}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"


def rows_in(path: str) -> int:
    if not Path(path).exists():
        return 0
    with open(path, encoding="utf-8-sig", newline="") as handle:
        return sum(any((v or "").strip() for v in row.values() if isinstance(v, str)) for row in csv.DictReader(handle))


def optional_json(path: str) -> dict:
    """A JSON file's value; empty where there is no file or it doesn't parse."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (FileNotFoundError, ValueError):
        return {}


def write_manifest(out_dir: str, run: str, inputs: Mapping[str, str], outputs: Mapping[str, str], counts: Mapping[str, int] | None = None, gate: Sequence[Mapping[str, str]] = (), metadata: Mapping[str, object] | None = None) -> dict:
    """run_manifest.json: identity, inputs, outputs, row counts (those of the writes, else read back) and the quality gate."""
    known = dict(counts or {})
    manifest = {
        "run_id": run, "generated_at": datetime.now(timezone.utc).replace(microsecond=0).isoformat(), "pipeline_version": VERSION, "git_commit": commit(), "input_files": dict(inputs), "output_files": dict(outputs),
        "row_counts": {k: known.get(k, rows_in(p) if k not in known else 0) for k, p in outputs.items() if p.endswith(".csv")}, "quality_gate_summary": [dict(g) for g in gate],
    }
    if metadata:
        manifest["metadata"] = dict(metadata)
    target = Path(out_dir) / "run_manifest.json"
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")
    return manifest

"""A data source that writes a table as one CSV file, with a byte-order mark and a header.

`df.write.format("csv_file").option("path", ...).option("columns", json).mode("overwrite").save()`

Two phases: each task writes its rows to a part of its own in a folder beside the target, under a name that
no other attempt has; the commit then joins the parts in the order of the partitions, so a sorted frame makes
a sorted file, and puts the whole over the target in one step. Rows never reach the driver, and the parts are
joined by the system without passing through Python. A failed task, commit or job leaves the old file as it
was and takes the parts away; parts of attempts that Spark gave up are not named in the commit and go with
the folder. The folder of the target must be one that the driver and all executors see.
"""

from __future__ import annotations

import csv
import io
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "csv_file"
#: Bytes that the system is asked to copy at once.
COPY = 64 << 20


def cell(value: object) -> str:
    """A value as an export writes it: null blank, true/false, lists and objects as JSON with sorted keys."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    return json.dumps(value, ensure_ascii=False, sort_keys=True) if isinstance(value, (list, dict)) else str(value)


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: the partition, the file, and its rows and bytes."""

    partition: int
    path: str
    rows: int
    size: int


class CsvFileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], names: list[str]):
        self.target, self.columns, self.names = Path(path), columns, names
        self.parts = self.target.with_name(f".{self.target.name}-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator) -> Part:
        from pyspark import TaskContext

        # the folder is made when the write is planned: an attempt that outlives its job finds none
        partition, rows = TaskContext.get().partitionId(), 0
        path = self.parts / f"{partition}-{uuid.uuid4().hex}"
        with path.open("w", encoding="utf-8", newline="") as handle:
            out = csv.writer(handle)
            for batch in iterator:
                held = {name: batch.column(k).to_pylist() for k, name in enumerate(self.names)}
                blank = [""] * batch.num_rows
                out.writerows(zip(*([cell(v) for v in held[c]] if c in held else blank for c in self.columns), strict=True))
                rows += batch.num_rows
            handle.flush()
            os.fsync(handle.fileno())
        return Part(partition, str(path), rows, path.stat().st_size)

    def commit(self, messages: list[Part | None]) -> None:
        rough = self.target.with_name(f"{self.parts.name}.whole")
        self.target.parent.mkdir(parents=True, exist_ok=True)
        head = io.StringIO()
        csv.writer(head).writerow(self.columns)
        try:
            with rough.open("wb") as out:
                out.write(f"﻿{head.getvalue()}".encode())
                out.flush()
                for part in sorted((m for m in messages if m), key=lambda m: m.partition):
                    append(out.fileno(), part.path, part.size)
                os.fsync(out.fileno())
            os.replace(rough, self.target)
        finally:
            rough.unlink(missing_ok=True)
            shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[Part | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


def append(out: int, path: str, size: int) -> None:
    """A file's bytes to the end of another, copied by the system; a part that isn't whole is an error."""
    with open(path, "rb") as part:
        at = 0
        while at < size:
            sent = os.sendfile(out, part.fileno(), at, min(COPY, size - at))
            if not sent:
                raise OSError(f"{path} has {at} of {size} bytes")
            at += sent


class CsvFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> CsvFileWriter:
        if not overwrite:
            raise ValueError("a CSV file is written whole: mode('overwrite')")
        made = CsvFileWriter(self.options["path"], json.loads(self.options["columns"]), schema.names)
        made.parts.mkdir(parents=True)
        return made

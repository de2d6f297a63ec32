"""CSV files read by many tasks, whatever their quoted line breaks.

Spark splits a file at line ends, but a line end may lie inside of a quoted cell. Whether a byte range
begins inside of one depends on all that is before it, so it is found by a prefix scan:

1. Each range is scanned for both cases, beginning outside and inside of quotes. That gives a function of
   two values, a row of a few numbers for each range. Only lines with a quote are looked at closely.
2. The driver composes these functions in the order of the file: one small row for each range (some
   128 MB), not one for each record.
3. Each range reads its records, from its first line that begins one. What it holds of a record that
   another range began, and of its own last one, are pieces; they meet by the range that began the record.

A quote opens a cell only at its start; a doubled quote in a quoted cell is one; what follows a closing
quote is plain text; a file that ends inside of quotes ends its last record, without the line break that
may stand there. These are the rules of Python's csv module, which reads the records.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provena.schemas import ORDER

#: Records in a range are numbered below this; ranges are numbered above it.
RECORDS = 36
MARK = "﻿"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files with the file and the start of the range that they were read in."""
    return spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


class Quotes:
    """Where quoted cells begin and end in lines."""

    def __init__(self, separator: str):
        end = re.escape(separator)
        self.separators, self.opening = re.compile(f"[{end}\r]"), re.compile(f'[{end}\r]"')

    def inside_after(self, line: str, inside: bool) -> bool:
        """Does the line end inside of a quoted cell, if it begins inside or outside of one?"""
        if '"' not in line:
            return inside
        at = 0
        while True:
            if inside:
                close = line.find('"', at)
                if close < 0:
                    return True
                if line.startswith('"', close + 1):
                    at = close + 2
                    continue
                found = self.separators.search(line, close + 1)
            elif line.startswith('"', at):
                inside, at = True, at + 1
                continue
            else:
                found = self.opening.search(line, at)
            if not found:
                return False
            inside, at = False, found.start() + 1


def batches_by_range(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """(file, start) and the lines of each range, in order; the lines must be used up before the next range."""
    pending: list[tuple[tuple[str, int], str]] = []
    rows = (((f, s), v) for b in batches for v, f, s in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))

    def lines(key: tuple[str, int], first: str) -> Iterator[str]:
        yield first
        for other, line in rows:
            if other != key:
                pending.append((other, line))
                return
            yield line

    while True:
        head = pending.pop() if pending else next(rows, None)
        if head is None:
            return
        yield head[0], lines(*head)


@dataclass(frozen=True)
class Range:
    """A byte range of the input: its number, whether it begins inside of quotes, and the range that began the record it begins in."""

    number: int
    inside: bool
    owner: int


def scanned(lines: DataFrame, separator: str) -> DataFrame:
    """file, start, out_to, in_to (does the range end inside, if it begins outside or inside), leaves (does a record begin in it, if it begins inside)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = Quotes(separator)
        for (file, start), held in batches_by_range(batches):
            ends, leaves = [False, True], False
            for k, line in enumerate(held):
                if k == 0 and start == 0:
                    line = line.removeprefix(MARK)
                ends = [quotes.inside_after(line, e) for e in ends]
                leaves = leaves or not ends[1]
            yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "out_to": ends[0], "in_to": ends[1], "leaves": leaves}])

    return lines.mapInArrow(run, "file string, start long, out_to boolean, in_to boolean, leaves boolean")


def ranges(lines: DataFrame, separator: str) -> dict[tuple[str, int], Range]:
    """Every range with its place and state: the functions of the ranges before it in its file, composed."""
    found: dict[tuple[str, int], Range] = {}
    file, inside, owner = None, False, 0
    for number, r in enumerate(sorted(scanned(lines, separator).collect(), key=lambda r: (r["file"], r["start"]))):
        if r["file"] != file:
            file, inside, owner = r["file"], False, number
        found[r["file"], r["start"]] = Range(number, inside, owner)
        if not inside or r["leaves"]:
            owner = number
        inside = r["in_to"] if inside else r["out_to"]
    return found


def with_breaks(lines: Iterable[str]) -> Iterator[str]:
    """Lines with their breaks, as csv.reader takes them."""
    for line in lines:
        if "\r" in line:
            yield from io.StringIO(f"{line}\n", newline="")
        else:
            yield f"{line}\n"


def parsed(lines: Iterable[str], separator: str) -> Iterator[list[str]]:
    """The records of lines that keep their breaks; a lone carriage return outside of quotes ends a record too."""
    csv.field_size_limit(sys.maxsize)
    return (row for row in csv.reader(lines, delimiter=separator) if row)


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """The records of the files at path: ORDER (a number that follows files and lines), cells (array of strings), first (is it the file's first record). Empty lines are none."""
    lines = lines_of(spark, path)
    known = ranges(lines, separator)
    firsts = {min((k for k in known if k[0] == f), key=lambda k: k[1]) for f in {k[0] for k in known}}
    heads = {known[k].number << RECORDS for k in firsts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = Quotes(separator)
        for key, held in batches_by_range(batches):
            if key not in known:
                raise RuntimeError(f"{key[0]} or the sizes of splits have changed since it was opened: read it again")
            here = known[key]
            pieces: list[tuple[int, int, str]] = []
            held = (line.removeprefix(MARK) if k == 0 and key in firsts else line for k, line in enumerate(held))
            if here.inside:
                rest, inside = [], True
                for line in held:
                    rest.append(line)
                    inside = quotes.inside_after(line, True)
                    if not inside:
                        break
                pieces.append((here.owner, here.number, "\n".join(rest)))
            last: list[str] = []

            def complete(last: list[str] = last, held: Iterator[str] = held) -> Iterator[str]:
                """The lines of records that end in this range; `last` keeps those of one that doesn't."""
                inside = False
                for line in held:
                    last.append(line)
                    inside = quotes.inside_after(line, inside)
                    if not inside:
                        yield from last
                        last.clear()

            rows, n = [], 0
            for row in parsed(with_breaks(complete()), separator):
                rows.append((here.number << RECORDS | n, row))
                n += 1
                if len(rows) == 4096:
                    yield batch_of(rows, [], heads)
                    rows = []
            if last:
                pieces.append((here.number, here.number, "\n".join(last)))
            yield batch_of(rows, [(owner, number, n, text) for owner, number, text in pieces], heads)

    schema = f"{ORDER} long, cells array<string>, first boolean, owner long, number long, piece string"
    found = lines.mapInArrow(run, schema)
    whole = found.filter("owner IS NULL").select(ORDER, "cells", "first")
    joined = found.filter("owner IS NOT NULL").groupBy("owner").agg(F.min_by(ORDER, "number").alias(ORDER), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "piece"))), lambda x: x["piece"]), "\n").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for order, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(order + k, row) for k, row in enumerate(parsed(io.StringIO(text, newline=""), separator))]
            yield batch_of(rows, [], heads).select([ORDER, "cells", "first"])

    return whole.unionByName(joined.select(ORDER, "text").mapInArrow(read, f"{ORDER} long, cells array<string>, first boolean"))


def first_record(spark: SparkSession, path: str, separator: str, size: int = 64) -> list[str]:
    """The first record of the first file; reads no more lines than it takes, twice as many each time."""
    lines = lines_of(spark, path).filter("start = 0")
    while True:
        head = lines.limit(size).collect()
        file = min((r["file"] for r in head), default=None)
        held = [r["value"] for r in head if r["file"] == file]
        held[:1] = [line.removeprefix(MARK) for line in held[:1]]
        inside, quotes, whole = False, Quotes(separator), 0
        for k, line in enumerate(held):
            inside = quotes.inside_after(line, inside)
            if not inside:
                whole = k + 1
        found = next(parsed(with_breaks(held[:whole]), separator), None)
        if found is not None:
            return found
        if len(head) < size:
            return next(parsed(io.StringIO("\n".join(held), newline=""), separator), [])
        size *= 2


def batch_of(rows: list[tuple[int, list[str]]], pieces: list[tuple[int, int, int, str]], heads: set[int]) -> pa.RecordBatch:
    """Records, and pieces of records as (owner, range, records before it, text)."""
    orders = [o for o, _ in rows] + [number << RECORDS | n for _, number, n, _ in pieces]
    none = [None] * len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(orders, pa.int64()), pa.array([r for _, r in rows] + [None] * len(pieces), pa.list_(pa.string())), pa.array([o in heads for o in orders], pa.bool_()),
            pa.array(none + [p[0] for p in pieces], pa.int64()), pa.array(none + [p[1] for p in pieces], pa.int64()), pa.array(none + [p[3] for p in pieces], pa.string()),
        ],
        names=[ORDER, "cells", "first", "owner", "number", "piece"],
    )

"""The n-th row in an order, found by counting: no task holds more than its share of the rows.

The range of the values is cut into equal buckets whose rows are counted, and the bucket that holds the n-th
row is cut again, until it is one value: two or three passes over numbers in practice, and one for each 12
bits at most. Only counts of buckets reach the driver. Orders of several parts are taken part by part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a pass, and so the most rows that a pass sends to the driver.
BUCKETS = 4096


def parts(name: str, kind: T.DataType) -> list[str]:
    """The numbers that an order column is made of, first to last."""
    return [p for f in kind.fields for p in parts(f"{name}.{f.name}", f.dataType)] if isinstance(kind, T.StructType) else [name]


def like(values: list[int], kind: T.DataType) -> Column:
    """Values as a literal of the order column's type."""
    left = iter(values)

    def made(kind: T.DataType) -> Column:
        return F.struct(*[made(f.dataType).alias(f.name) for f in kind.fields]) if isinstance(kind, T.StructType) else F.lit(next(left)).cast(kind)

    return made(kind)


def _nth_number(rows: DataFrame, name: str, n: int) -> tuple[int, int]:
    """(the n-th smallest number from 1, how many are smaller)."""
    x = F.col(name).cast("long")
    low, high = rows.agg(F.min(x), F.max(x)).first()
    smaller = 0
    while True:
        width = max(1, -(-(high - low + 1) // BUCKETS))
        counts = sorted(rows.filter(x.between(low, high)).groupBy(F.expr(f"(CAST({name} AS LONG) - {low}L) div {width}L").alias("bucket")).count().collect())
        for bucket, count in counts:
            if smaller + count >= n:
                break
            smaller += count
        if width == 1:
            return low + bucket, smaller
        low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)


def nth(rows: DataFrame, column: str, n: int) -> Column | None:
    """The value of the order column in its n-th row (from 1) as a literal; the last one where there are fewer rows, None where there are none.

    rows are read several times: give a written table.
    """
    total = rows.count()
    if not total or n < 1:
        return None
    n, kind, found, held = min(n, total), rows.schema[column].dataType, [], rows
    for name in parts(column, kind):
        value, smaller = _nth_number(held, name, n)
        found.append(value)
        n, held = n - smaller, held.filter(F.col(name) == value)
    return like(found, kind)

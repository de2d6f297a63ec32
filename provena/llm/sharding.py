"""Sharding by extendible hashing.

Rows hash to bits; a directory is indexed by a prefix of those bits. A bucket that holds more bytes
than the limit splits on its next bit, the others stay: neighbours keep their shard when one bucket
overflows. The first `KEY_BITS` bits come from the key (so that copies of a key lie together while
they fit), those after it from a hash of key, text and a row number fixed once, so a hot key or
group of copies splits too instead of overflowing.

Sizes are added up over hash cells (map-side first); only cells of buckets that are still too large
go on to the next depth. A row that alone is larger than the limit is a shard of its own
(`oversize`).

Defined results: a null text has 0 bytes; a null key hashes as the empty text; repeated rows are
rows of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import cut

KEY_BITS = 32
MAX_BITS = 64
LIMIT = 16 << 20


def prefix(code: Column, depth: Column) -> Column:
    """The first `depth` of 64 bits, as a string of 0 and 1."""
    return F.substring(code, F.lit(1), depth)


def bits(key: Column, tie: Column) -> Column:
    """64 bits as text: 32 of the md5 of the key, 32 of the md5 of key and tie."""
    first = F.conv(F.substring(F.md5(key), 1, 8), 16, 2)
    second = F.conv(F.substring(F.md5(F.concat_ws("/", key, tie)), 1, 8), 16, 2)
    return F.concat(F.lpad(first, KEY_BITS, "0"), F.lpad(second, MAX_BITS - KEY_BITS, "0"))


def shard(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, step: int = 8) -> DataFrame:
    """key, n_bytes, shard (its bits; empty while one shard holds all), depth, shard_bytes, oversize for each row."""
    key = F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    rows = df.select(F.col(f"`{key_col}`").alias("key"), size.alias("n_bytes"), bits(key, F.monotonically_increasing_id().cast("string")).alias("code"))
    rows = cut(rows)
    leaves = None
    active, depth = rows, 0
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    # buckets this shallow hold a sixteenth of the limit on average or more: one cell table serves all depths up to it
    reach = min(MAX_BITS, max(step, int(max(1, 16 * total // limit)).bit_length()))
    while depth <= MAX_BITS:
        cells = cut(active.groupBy(F.substring("code", 1, reach).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")))
        while depth <= reach:
            sized = cells.groupBy(F.substring("cell", 1, depth).alias("shard")).agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("n_rows"))
            small = (F.col("shard_bytes") <= limit) | (F.col("n_rows") == 1) | F.lit(depth == MAX_BITS)
            now = sized.filter(small).select("shard", F.lit(depth).alias("depth"), "shard_bytes")
            leaves = now if leaves is None else leaves.unionByName(now)
            large = sized.filter(~small).select("shard")
            cells = cells.withColumn("shard", F.substring("cell", 1, depth)).join(large, "shard", "left_semi").drop("shard")
            depth += 1
            if depth % 4 == 0:
                cells, leaves = cut(cells), cut(leaves)
        cells, leaves = cut(cells), cut(leaves)
        if cells.isEmpty():
            break
        open_cells = cells.select(F.col("cell").alias("open"))
        active = cut(active.join(open_cells, F.substring("code", 1, reach) == F.col("open"), "left_semi"))
        reach = min(MAX_BITS, reach + step)
    # a row's shard is the only leaf that is a prefix of its code: probe the depths that leaves have
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]
    probes = F.array(*[F.substring("code", 1, d) for d in sorted(depths)]) if depths else F.array(F.lit(""))
    found = rows.withColumn("probe", F.explode(probes)).join(leaves, F.col("probe") == F.col("shard"))
    return found.select(F.col("key").alias(key_col), "n_bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", (F.col("shard_bytes") > limit).alias("oversize"))

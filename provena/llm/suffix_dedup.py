"""Removal of passages that repeat across documents: a logarithmic family of suffix arrays.

A byte goes if a string of `span` (50) bytes that covers it also starts in a document with a smaller id.
Texts are UTF-8 bytes, matches never cross documents, and strings are judged on the input.

* Suffixes. Of each 35 consecutive suffixes of a document one is picked, by the least hash of its first
  16 bytes (the leftmost of equal ones), so every string of 50 bytes holds the beginning of a picked
  suffix, and equal strings pick the same one. The strings that pick one suffix form a run.
* Family. Documents come in `batches`, in the order of their ids. The picked suffixes of a batch become
  suffix arrays, one for each of many shards, sorted by the 16 bytes. A batch's array is merge-scanned
  against all levels of the shard; what no level holds becomes a new level, and levels of equal rank merge,
  so there are at most log2(batches) + 1 of them and each suffix is rewritten as often at most. A level
  holds each suffix once, with the segment of documents that it came from. The scan tells segments which
  of their suffixes others share, and whether an earlier document does.
* Three families follow each other: (1) suffixes by their 16 bytes. (2) Of suffixes that documents share:
  the whole run, and the 33 bytes left and right of the suffix, without which no string of 50 bytes on that
  side can be shared. A run that an earlier document holds goes as a whole. (3) Of the other runs: each
  string of 50 bytes whose side lies in different runs. The keys of (2) and (3) are 64-bit fingerprints.

Every key is sent at most once for each segment (some 4 MB of text), whatever the number of documents that
hold it, so a passage or a copy that lies in a third of all documents costs a shard one entry a segment.
Shards are tasks' groups of a bounded size: their number grows with the bytes of text, as does that of the
segments. Texts never meet each other; only keys move. Two different strings with equal fingerprints would
count as equal: at 10^8 keys the chance that any do is about 3 in 10,000.

Defined results: a null text is empty; rows that share an id don't remove anything from each other; a row
with a null id is kept whole and removes nothing; an empty table gives an empty result; extra columns are
ignored. Rows repeated under one id lie in one segment. Very long texts are cut into pieces of `PIECE`
strings for work in memory, which changes no result.
"""

from __future__ import annotations

import uuid
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena.llm.common import CLEANUP, mix64, remove, shared_dir

SPAN = 50
PREFIX = 16
PICK = SPAN - PREFIX + 1
#: A side: the suffix's 16 bytes and 17 more to the left or right.
SIDE = PICK // 2
BATCHES = 4
#: Bytes of text in a segment and behind a shard, on average, and the least number of either.
SEGMENT, SHARD, LEAST = 4 << 20, 8 << 20, 64
#: Strings whose suffixes are picked together.
PIECE = 1 << 17
ONE = np.uint64(1)
OLDER, NONE = np.iinfo(np.int64).min, np.iinfo(np.int64).max
ODD, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

ASKS = "segment int, shard int, n int, keys binary, low binary, range binary, value binary"
MADE = "kind string, place int, rank int, n int, keys binary, first binary, value binary"


def pack(values: np.ndarray) -> bytes:
    """An array of 64-bit numbers with equal bytes of all numbers side by side, which compresses well if sorted."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes, kind=np.uint64, n: int = 0) -> np.ndarray:
    """What pack or pack_some made of numbers, in the latter case n of them."""
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(kind).ravel() if data else np.zeros(n, kind)


def pack_some(values: np.ndarray) -> bytes:
    """Nothing for zeros only."""
    return pack(values) if values.any() else b""


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    """Keys as [column, number]; a key has one or two columns."""
    return unpack(data).reshape(-1, n)


class Runs:
    """The picked suffixes of a list of texts and the strings that pick them.

    doc: place of the text; first, last: where the run's strings start, in the bytes of all texts; at: where
    the suffix starts.
    """

    def __init__(self, texts: pa.Array):
        self.lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.data = b"".join([*(t.as_buffer() for t in texts if t.is_valid), b"\0" * 64])
        n = len(self.data) - 64
        #: the eight bytes that start at each place, most significant first
        self.words = np.ndarray((n + 56,), ">u8", self.data, strides=(1,))
        found = [self._piece(at, min(at + PIECE, n - SPAN + 1)) for at in range(0, n - SPAN + 1, PIECE)]
        self.first, self.last, self.at = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def _piece(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = high - low + PICK - 1
        words = self.words[low : low + size + 8].astype(np.uint64)
        best = words[8:] * ODD2
        best ^= words[:-8]
        best *= ODD
        best &= np.uint64(0xFFFFFFFF00000000)
        best |= np.arange(size, dtype=np.uint64)
        width = 1
        while 2 * width <= PICK:
            best, width = np.minimum(best[:-width], best[width:]), 2 * width
        at = np.minimum(best[: high - low], best[PICK - width : PICK - width + high - low]).astype(np.uint32).astype(np.int64)
        # what starts in the last bytes of a text would reach into the next one
        start, stop = np.searchsorted(self.ends, low, side="right"), np.searchsorted(self.ends, high + SPAN, side="right")
        for end in self.ends[start:stop].tolist():
            at[max(0, end - SPAN + 1 - low) : max(0, end - low)] = -1
        edge = np.flatnonzero(at[1:] != at[:-1]) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [high - low]]) - 1
        held = at[first] >= 0
        return first[held] + low, last[held] + low, at[first[held]] + low

    def take(self, which: np.ndarray) -> None:
        self.first, self.last, self.at, self.doc = self.first[which], self.last[which], self.at[which], self.doc[which]

    def prefixes(self) -> np.ndarray:
        return np.stack([self.words[self.at], self.words[self.at + 8]]).astype(np.uint64)

    def prints(self, start: np.ndarray, stop: np.ndarray, kind: int) -> np.ndarray:
        """Fingerprints of strings of at least 8 bytes."""
        found = mix64((stop - start).astype(np.uint64) * ODD + np.uint64(kind))
        last = stop - 8
        for k in range(0, int((stop - start).max(initial=0)), 8):
            found ^= self.words[np.minimum(start + k, last)].astype(np.uint64)
            found *= ODD
            found ^= found >> np.uint64(29)
        return mix64(found)

    def whole(self) -> np.ndarray:
        """Of each run's bytes and the place of its suffix in them; even."""
        return mix64(self.prints(self.first, self.last + SPAN, 1) + (self.at - self.first).astype(np.uint64) * ODD) & ~ONE

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        """(runs with strings that reach SIDE bytes to the left of the suffix, fingerprints of that side; odd)."""
        which = np.flatnonzero(self.at - self.first >= SIDE)
        return which, self.prints(self.at[which] - SIDE, self.at[which] + PREFIX, 2) | ONE

    def right(self) -> tuple[np.ndarray, np.ndarray]:
        which = np.flatnonzero(self.at - self.last < SIDE)
        return which, self.prints(self.at[which], self.at[which] + PREFIX + SIDE, 3) | ONE

    def strings(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, start) of the strings of the runs in `held`."""
        sizes = (self.last - self.first + 1)[held]
        run = np.repeat(held, sizes)
        start = np.repeat(self.first[held] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(run))
        return run, start


def known(answers: pa.Table | None, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys that a family answered, and the first document with each (OLDER: before this batch; NONE: not before the asking one)."""
    rows = [] if answers is None else answers.filter(pc.equal(answers["kind"], kind)).select(["keys", "first"]).to_pylist()
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, first = np.concatenate([unpack(r["keys"]) for r in rows]), np.concatenate([unpack(r["first"], np.int64) for r in rows])
    order = np.lexsort((first, keys))
    keys, first = keys[order], first[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[new], first[new]


def look(answers: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the key shared, the first document with it)."""
    held, first = answers
    hit, found = np.zeros(len(keys), bool), np.full(len(keys), NONE)
    if len(held):
        # most keys aren't held: a table of low bits tells it sooner than a search
        low = np.uint64((1 << min(24, (8 * len(held)).bit_length())) - 1)
        table = np.zeros(int(low) + 1, bool)
        table[held & low] = True
        maybe = np.flatnonzero(table[keys & low])
        at = np.minimum(np.searchsorted(held, keys[maybe]), len(held) - 1)
        sure = held[at] == keys[maybe]
        hit[maybe[sure]] = True
        found[maybe[sure]] = first[at[sure]]
    return hit, found


def lookup_key(keys: np.ndarray) -> np.ndarray:
    """One number for each key. Suffixes that share one by chance are only looked at more closely."""
    return keys[0] if len(keys) == 1 else mix64(keys[0] * ODD + mix64(keys[1]))


Asked = tuple[np.ndarray, np.ndarray, np.ndarray]


def suffix_asks(runs: Runs, ids: np.ndarray, answers: pa.Table | None) -> Asked:
    """Keys as [column, number], the ids that have them and the values that go with them."""
    return runs.prefixes(), ids[runs.doc], np.zeros(len(runs.at), np.int64)


def run_asks(runs: Runs, ids: np.ndarray, answers: pa.Table | None) -> Asked:
    runs.take(look(known(answers, "suffix"), lookup_key(runs.prefixes()))[0])
    whole, left, right = runs.whole(), runs.left(), runs.right()
    # of a side it matters which runs have it: strings of equal runs are equal
    owners = np.concatenate([np.arange(len(whole)), left[0], right[0]])
    values = whole[owners].view(np.int64)
    values[: len(whole)] = 0
    return np.concatenate([whole, left[1], right[1]])[None], ids[runs.doc[owners]], values


def open_strings(runs: Runs, ids: np.ndarray, answers: pa.Table | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is each run gone as a whole, runs and starts of the strings that family 3 looks at)."""
    answered = known(answers, "run")
    gone = look(answered, runs.whole())[1] < ids[runs.doc]
    sides = []
    for which, prints in (runs.left(), runs.right()):
        side = np.zeros(len(runs.at), bool)
        side[which] = look(answered, prints)[0]
        sides.append(side)
    run, start = runs.strings(np.flatnonzero(~gone & (sides[0] | sides[1])))
    held = np.where(runs.at[run] - start >= SIDE, sides[0][run], sides[1][run])
    return gone, run[held], start[held]


def string_asks(runs: Runs, ids: np.ndarray, answers: pa.Table | None) -> Asked:
    _, run, start = open_strings(runs, ids, answers)
    return runs.prints(start, start + SPAN, 4)[None], ids[runs.doc[run]], np.zeros(len(run), np.int64)


FAMILIES = {"suffix": suffix_asks, "run": run_asks, "string": string_asks}


def sorted_once(keys: np.ndarray, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(the order of the keys, equal ones by id if ids are given, and where equal ones begin in it)."""
    order = np.argsort(keys[0])
    rest = [*keys[1:], *([] if ids is None else [ids])]
    same = keys[0][order][1:] == keys[0][order][:-1]
    if rest and same.any():
        # only where first columns are equal do the others decide
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        order[tied] = order[tied][np.lexsort([c[order[tied]] for c in (*rest[::-1], keys[0])])]
    there = keys[:, order]
    return order, np.flatnonzero(np.concatenate([[True], (there[:, 1:] != there[:, :-1]).any(axis=0)])) if len(order) else order


def asks(docs: DataFrame, answers: DataFrame | None, family: str, shards: int) -> DataFrame:
    """The keys that each segment of docs (segment, id, text) asks a family for, once each, with the least id that has it."""
    make = FAMILIES[family]

    def rows(texts: pa.Table, answered: pa.Table | None) -> pa.Table:
        runs = Runs(texts["text"].combine_chunks())
        keys, ids, values = make(runs, texts["id"].to_numpy(), answered)
        # the least id, with its value; how far the other ids are from it, or whether values differ
        order, start = sorted_once(keys, ids if values.any() else None)
        keys, ids, values = keys[:, order], ids[order], values[order]
        most = lambda a: np.maximum.reduceat(a, start) if len(start) else a
        low, value = -most(-ids), values[start]
        width = np.where(value != 0, most(values) != -most(-values), most(ids) - low)
        keys = keys[:, start]
        shard = (mix64(lookup_key(keys) + ODD) % np.uint64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[by], np.arange(shards + 1))
        out = [(s, b[1] - b[0], pack(keys[:, by[b[0] : b[1]]]), pack(low[by[b[0] : b[1]]]), pack_some(width[by[b[0] : b[1]]]), pack_some(value[by[b[0] : b[1]]])) for s, b in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b[1] > b[0]]
        segment = texts["segment"][0].as_py() if texts.num_rows else 0
        columns = list(zip(*out, strict=True)) or [[]] * 6
        return pa.table([pa.array([segment] * len(out), pa.int32()), *(pa.array(c, pa.int32()) for c in columns[:2]), *(pa.array(c, pa.binary()) for c in columns[2:])], names=["segment", "shard", "n", "keys", "low", "range", "value"])

    docs = docs.select("segment", "id", "text")
    if answers is None:
        return docs.groupBy("segment").applyInArrow(lambda texts: rows(texts, None), ASKS)
    return docs.groupBy("segment").cogroup(answers.groupBy("place")).applyInArrow(rows, ASKS)


def scan(batch: DataFrame, levels: DataFrame, fold: frozenset[int], rank: int, sides: bool = False) -> DataFrame:
    """One batch of asks against all levels, shard by shard: answers by segment, and the new level of `rank`, into which those of `fold` merge.

    A key is shared if a level or another segment has it, or another id in its own. With `sides`, odd keys are
    sides: one is shared if the runs that have it differ, so a level keeps its run.
    """

    def rows(asked: pa.Table, held: pa.Table) -> pa.Table:
        asked, held = asked.to_pylist(), held.to_pylist()
        shard = asked[0]["shard"] if asked else held[0]["place"]
        parts = [unpack_keys(r["keys"], r["n"]) for r in (*asked, *held)]
        sizes = np.array([p.shape[1] for p in parts])
        n = int(sizes[: len(asked)].sum())
        keys = np.concatenate(parts, axis=1)
        # of asks the segment, of a level's suffixes the one that they came from
        origin = np.concatenate([np.repeat([r["segment"] for r in asked], sizes[: len(asked)]), *(unpack(r["first"], np.int64) for r in held)]).astype(np.int64)
        side = (keys[0] & ONE).astype(bool) if sides else np.zeros(len(origin), bool)
        value = np.concatenate([unpack(r["value"], np.int64, r["n"]) for r in (*asked, *held)])
        low = np.concatenate([*(unpack(r["low"], np.int64) for r in asked), np.full(len(origin) - n, NONE)])
        width = np.concatenate([*(unpack(r["range"], np.int64, r["n"]) for r in asked), np.zeros(len(origin) - n, np.int64)])
        order, start = sorted_once(keys, low if sides else None)
        asking = order < n
        least, values = np.minimum.reduceat(low[order], start), value[order]
        # ids differ where no level has the key, or runs do
        differ = np.maximum.reduceat(width[order], start) > 0
        differ |= np.where(side[order[start]], np.maximum.reduceat(values, start) != np.minimum.reduceat(values, start), False)
        members = np.add.reduceat(asking, start, dtype=np.int64)
        group = np.repeat(np.arange(len(start)), np.diff([*start, len(order)]))
        older = np.add.reduceat(~asking, start, dtype=np.int64) > 0
        shared = (members > 0) & (differ | (~side[order[start]] & (older | (members > 1))))
        told = shared[group]
        first = np.where(asking, np.where(older, OLDER, least)[group], NONE)[told]
        where, answer = origin[order[told]], lookup_key(keys[:, order[told]])
        by = np.argsort(where, kind="stable")
        out = []
        for places in np.split(by, np.flatnonzero(np.diff(where[by])) + 1) if len(by) else []:
            out.append(("answer", int(where[places[0]]), 0, len(places), pack(answer[places]), pack(first[places]), b""))
        # what no level holds, and the levels that it merges with; a level's own suffix stands alone or beside asks
        level = np.concatenate([np.zeros(n, np.int64), np.repeat([r["rank"] for r in held], sizes[len(asked) :]).astype(np.int64)])[order]
        stays = np.where(asking, ~older[group] & (np.arange(len(order)) == start[group]), np.isin(level, list(fold)))
        kept = order[stays]
        if len(kept):
            out.append(("level", shard, rank, len(kept), pack(keys[:, kept]), pack(origin[kept]), pack_some(value[kept])))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        return pa.table([pa.array(columns[0], pa.string()), *(pa.array(columns[k], pa.int32()) for k in (1, 2, 3)), *(pa.array(columns[k], pa.binary()) for k in (4, 5, 6))], names=["kind", "place", "rank", "n", "keys", "first", "value"])

    return batch.groupBy("shard").cogroup(levels.groupBy("place")).applyInArrow(rows, MADE)


def write(df: DataFrame, path: str, by: str) -> set[str]:
    """df as Parquet, a folder for each value of `by`, and the values written. The shuffle files behind it go at once."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(by).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)]
    return {n.partition("=")[2] for n in names if n.startswith(f"{by}=")}


class Family:
    """The levels of one family and what it has answered; its tables lie under `folder`."""

    def __init__(self, spark, folder: str, name: str):
        self.spark, self.folder, self.name, self.size = spark, folder, name, 0
        self.levels: dict[int, str] = {}
        self.answered: dict[int, list[str]] = {}

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(MADE).parquet(*paths) if paths else self.spark.createDataFrame([], MADE)

    def add(self, asked: DataFrame, segments: int = 1) -> None:
        """Scan a batch and take it in as a level; levels of ranks 0, 1, ... that are full merge into it. Answers are kept by the batch of their segment, of which each has so many."""
        rank = 0
        while self.size >> rank & 1:
            rank += 1
        fold = frozenset(range(rank))
        path = f"{self.folder}/{self.name}-{self.size}"
        made = scan(asked, self._read(list(self.levels.values())), fold, rank, sides=self.name == "run")
        found = write(made.withColumn("of", F.when(F.col("kind") == "level", "level").otherwise(F.floor(F.col("place") / segments).cast("string"))), path, "of")
        for old in fold:
            if old in self.levels:
                remove(self.spark, self.levels.pop(old))
        for of in found:
            if of == "level":
                self.levels[rank] = f"{path}/of=level"
            else:
                self.answered.setdefault(int(of), []).append(f"{path}/of={of}")
        self.size += 1

    def take(self, batches: list[DataFrame], before: Family | None, segments: int, shards: int) -> None:
        """All documents, batch after batch. The levels go at the end."""
        for k, docs in enumerate(batches):
            self.add(asks(docs, before and before.answers(k), self.name, shards), segments)
        for level in self.levels.values():
            remove(self.spark, level)
        self.levels = {}

    def answers(self, batch: int | None = None) -> DataFrame:
        """What the segments of a batch were told, or all."""
        paths = [p for k, ps in self.answered.items() if batch in (None, k) for p in ps]
        return self._read(paths).withColumn("kind", F.lit(self.name))

    def drop(self) -> None:
        for path in [p for ps in self.answered.values() for p in ps]:
            remove(self.spark, path)


def kept(runs: Runs, ids: np.ndarray, answers: pa.Table | None) -> tuple[list, list]:
    """(removed spans as [start, end] in the text's bytes, remaining bytes) of each text."""
    gone, run, start = open_strings(runs, ids, answers)
    hit = look(known(answers, "string"), runs.prints(start, start + SPAN, 4))[1] < ids[runs.doc[run]]
    low = np.concatenate([runs.first[gone], start[hit]])
    high = np.concatenate([runs.last[gone], start[hit]]) + SPAN
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order]) if len(order) else high
    doc = np.searchsorted(runs.ends, low, side="right")
    # spans that touch are one, but not across documents
    edge = np.flatnonzero(np.concatenate([[True], (low[1:] > reach[:-1]) | (doc[1:] != doc[:-1])])) if len(low) else order
    starts, stops, owner = low[edge], reach[np.concatenate([edge[1:], [len(low)]]).astype(np.int64) - 1] if len(low) else low, doc[edge]
    spans, rest = [], []
    bounds = np.searchsorted(owner, np.arange(len(runs.ends) + 1))
    for d, (end, size) in enumerate(zip(runs.ends.tolist(), runs.lengths.tolist(), strict=True)):
        begin = end - size
        mine = [(int(a), int(b)) for a, b in zip(starts[bounds[d] : bounds[d + 1]], stops[bounds[d] : bounds[d + 1]], strict=True)]
        spans.append([[a - begin, b - begin] for a, b in mine])
        rest.append(b"".join(runs.data[a:b] for a, b in zip([begin, *(b for _, b in mine)], [*(a for a, _ in mine), end], strict=True)))
    return spans, rest


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, segment_bytes: int = SEGMENT, shard_bytes: int = SHARD) -> DataFrame:
    """id, n_bytes, spans (array of [start, end) of the removed bytes), kept (the remaining bytes), a row for each row. Ids are whole numbers.

    A segment sends one row to each shard that it has keys for, so `segment_bytes` and `shard_bytes` should
    grow where both numbers reach tens of thousands; a task holds about ten times either.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # batches of about equal numbers of rows, in the order of ids
    quantiles = [k / batches for k in range(1, batches)]
    bytes_, cuts = rows.filter("id IS NOT NULL").agg(F.sum(F.octet_length("text")), F.percentile_approx("id", quantiles, 10_000)).first()
    segments = max(1, max(LEAST, -(-(bytes_ or 0) // segment_bytes)) // batches)
    shards = max(LEAST, -(-(bytes_ or 0) // shard_bytes))
    cuts = sorted(set(cuts or []))
    batch = sum((F.coalesce(F.col("id") > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    docs = rows.withColumn("segment", (batch * segments + F.pmod(F.xxhash64("id", "text"), F.lit(segments))).cast("int"))
    # ranges of ids, so that files which are sorted by them are read in part
    parts = [docs.filter(F.col("id").isNotNull() & (F.lit(True) if low is None else F.col("id") > low) & (F.lit(True) if high is None else F.col("id") <= high)) for low, high in zip([None, *cuts], [*cuts, None], strict=True)]
    folder = f"{shared_dir(spark)}/provena/{uuid.uuid4().hex}"
    families = [Family(spark, folder, name) for name in FAMILIES]
    for before, family in zip([None, *families], families):  # noqa: B905
        family.take(parts, before, segments, shards)
        if before is families[0]:
            before.drop()
    answers = families[1].answers().unionByName(families[2].answers())
    # a null id asks for nothing: OLDER is never below it
    finished = docs.groupBy("segment").cogroup(answers.groupBy("place")).applyInArrow(_finish, "id long, n_bytes long, spans array<array<long>>, kept binary")
    return finished.withColumnRenamed("id", id_col)


def _finish(texts: pa.Table, answered: pa.Table) -> pa.Table:
    ids = texts["id"]
    runs = Runs(texts["text"].combine_chunks())
    sizes = runs.lengths
    spans, rest = kept(runs, pc.fill_null(ids, OLDER).to_numpy(), answered)
    return pa.table({"id": ids, "n_bytes": sizes, "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))), "kept": pa.array(rest, pa.binary())})


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = remove_repeats(df, id_col, text_col, **options)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

"""Best-fit packing of token sequences with certified bin counts.

1. `tokenize` cuts each document's ids (with an end id) into pieces of at most `size` tokens;
   only longer documents are cut. Narrow.
2. `pack` fills sequences: pieces of full length are sequences of their own. The others are dealt
   to partitions by a hash; each partition packs with best-fit decreasing over its lengths and
   compares its number of bins with a lower bound from dual-feasible functions. A partition whose
   bins equal the bound is certified and frozen; one with a gap freezes its full bins and gives
   the pieces of the others to an exchange: they are dealt anew, over fewer partitions, and packed
   again, until no partition is left but one with a gap or nothing is gained.

Between rounds only (slot, length) rows move; places meet the pieces in one last join. A partition is a bounded number of
pieces (`per_partition`), whatever the input's size.

Defined results: a null or empty text has the end id alone; a null id is carried through; repeated
rows are packed once each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena.llm.common import Words, annotate, columns, cut, strings

SIZE = 2048
PER_PARTITION = 40_000
CACHE = 700_000
#: Share of the waiting pieces above which a round has gained nothing.
STALLED = 0.95
#: Stands between words that are encoded together; words that hold it are encoded alone.
MARK = "\u241f"
ENDINGS = ".,;:!?*#$%&|<>)"


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces flat[start : start + size] one after the other, and where each starts, with the end."""
    bounds = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=bounds[1:])
    at = np.repeat(start - bounds[:-1], size)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at], bounds


class WordIds:
    """Ids of texts through a tokenizer that never joins what white space parts: each distinct word core is encoded once and remembered.

    The ids of known cores lie in one flat array; a text's ids are gathered from it. A word's closing
    marks and, for ASCII words, its case are taken off before it is encoded, where the tokenizer
    itself parts and folds them.
    """

    def __init__(self, tokenizer_path: str, whole: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.whole = Tokenizer.from_file(tokenizer_path), whole
        self.forget()
        self.mark = self.encoded(MARK)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.array([str(self.tokenizer.id_to_token(k)).endswith(suffix) for k in range(self.tokenizer.get_vocab_size())]) if suffix else None
        joined = lambda core, end: self.encoded(core + end).tolist() == [*self.encoded(core), *self.encoded(end)]
        self.folds = self.encoded("aB").tolist() == self.encoded("ab").tolist()
        self.parts = all(joined("aB", e + f) and joined("\u00e9", e + f) for e in ENDINGS for f in ("", *ENDINGS))

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def bare(self, words: pa.Array) -> tuple[pa.Array, list[str]]:
        """The words' cores and closing marks."""
        core, ends = words, [""] * len(words)
        if self.parts:
            bare = pc.utf8_rtrim(words, ENDINGS)
            # a mark may join what stands before it, unless that is all letters, also when normalised and lower-cased
            letters = pc.and_(pc.utf8_is_alpha(bare), pc.and_not(pc.equal(pc.utf8_normalize(bare, "NFC"), bare), pc.match_substring(bare, "\u0130")))
            core = pc.if_else(letters, bare, words)
            marked = pc.and_(letters, pc.not_equal(bare, words))
            sizes = pc.utf8_length(bare.filter(marked)).to_pylist()
            for k, word, n in zip(np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist(), words.filter(marked).to_pylist(), sizes, strict=True):
                ends[k] = word[n:]
        return pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core) if self.folds else core, ends

    def batch(self, words: list[str], between: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """Groups of the words, and the ids of each group's words joined."""
        for at in range(0, len(words), 64 * 64):
            groups = [words[k : k + 64] for k in range(at, min(at + 64 * 64, len(words)), 64)]
            for group, coded in zip(groups, self.tokenizer.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False), strict=True):
                yield group, np.array(coded.ids, np.uint32)

    def learn(self, words: list[str]) -> None:
        """Encode words (distinct ones, not yet known)."""
        letters, others, alone = [], [], []
        for w in words:
            (alone if MARK in w or not w else letters if self.closes is not None and w.isalpha() else others).append(w)
        order, ids, sizes = [], [], []
        for group, found in self.batch(letters, " "):
            # every word ends with a token that closes one; with as many of them as words, each word has one
            ends = np.flatnonzero(self.closes[found])
            if len(ends) == len(group):
                order += group
                ids.append(found)
                sizes.append(np.diff(ends, prepend=-1))
            else:
                others += group
        for group, found in self.batch(others, f" {MARK} "):
            parts = parted(found, self.mark)
            if len(parts) == len(group):
                order += group
                ids += parts
                sizes.append([len(p) for p in parts])
            else:
                alone += group
        for w in alone:
            order.append(w)
            ids.append(self.encoded(w))
            sizes.append([len(ids[-1])])
        size = np.concatenate(sizes).astype(np.int32)
        first, end, last = len(self.known), self.used + int(size.sum()), len(self.known) + len(order)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while last > len(self.start):
            self.start, self.size = np.concatenate([self.start, np.zeros_like(self.start)]), np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : end] = np.concatenate(ids)
        self.start[first:last] = self.used + np.cumsum(size) - size
        self.size[first:last] = size
        self.known.update(zip(order, range(first, last), strict=True))
        self.used = end

    def numbers(self, words: list[str]) -> np.ndarray:
        if new := [w for w in dict.fromkeys(words) if w not in self.known]:
            self.learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def of(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with end_id behind it, and where each text's end."""
        if self.whole:
            parts = [np.array([*e.ids, end_id], np.uint32) for e in self.tokenizer.encode_batch_fast(strings(texts), add_special_tokens=False)]
            return np.concatenate(parts or [np.zeros(0, np.uint32)]), np.cumsum([len(p) for p in parts], dtype=np.int64)
        words = Words(texts)
        if len(self.known) > CACHE:
            self.forget()
        core, ends = self.bare(words.vocabulary)
        coded = core.dictionary_encode()
        marks = {e: k for k, e in enumerate(dict.fromkeys(ends))}
        number = self.numbers([*coded.dictionary.to_pylist(), *marks, ""])
        n = len(coded.dictionary)
        # a vocabulary word is its core and its marks; the last one stands for the end of a text
        pair = np.empty((len(ends) + 1, 2), np.int32)
        pair[:-1, 0] = number[:n][coded.indices.to_numpy()]
        pair[:-1, 1] = number[n:][np.fromiter(map(marks.__getitem__, ends), np.int32, len(ends))]
        pair[-1] = number[-1]
        flat, bounds = gathered(self.flat, self.start[pair.ravel()], self.size[pair.ravel()])
        flat, start = np.append(flat, np.uint32(end_id)), bounds[:-1:2]
        size = np.diff(bounds[::2])
        start, size = start.copy(), size.copy()
        start[-1], size[-1] = len(flat) - 1, 1
        codes = np.insert(words.codes, words.starts[1:], len(ends))
        ids, at = gathered(flat, start[codes], size[codes])
        return ids, at[words.starts[1:] + np.arange(1, len(words.starts))].astype(np.int64)


def parted(ids: np.ndarray, mark: np.ndarray) -> list[np.ndarray]:
    """ids cut at each occurrence of the mark's ids."""
    n = len(mark)
    hit = np.ones(max(0, len(ids) - n + 1), bool)
    for k in range(n):
        hit &= ids[k : len(ids) - n + 1 + k] == mark[k]
    out, start = [], 0
    for at in np.flatnonzero(hit):
        out.append(ids[start:at])
        start = at + n
    return [*out, ids[start:]]


@lru_cache(maxsize=1)
def word_ids(tokenizer_path: str, whole: bool) -> WordIds:
    """One for each Python worker: its memory of words serves all tasks, and is bounded by CACHE."""
    return WordIds(tokenizer_path, whole)


def tokenize(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = 0, with_ids: bool = True, whole_texts: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, with_ids, ids (array<int>) for each piece.

    whole_texts: encode texts in one go, for tokenizers whose tokens may cross white space.
    """

    def worker():
        words = word_ids(tokenizer_path, whole_texts)

        def run(texts: pa.Array) -> tuple[np.ndarray, list]:
            ids, ends = words.of(texts, end_id)
            total = np.diff(ends, prepend=0)
            pieces = -(-total // size)
            row = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * size
            length = np.minimum(total[row] - start, size)
            first = (ends - total)[row] + start
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            found = [piece.astype(np.int32), start, length, crc]
            if with_ids:
                # pieces follow each other in ids without a gap
                found.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
            return row, found

        return run

    fields = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return annotate(df, columns(df, [id_col]), F.col(f"`{text_col}`"), worker, fields)


def lower_bound(lengths: np.ndarray, size: int = SIZE) -> int:
    """Bins that any packing needs: the largest of the bounds that a family of dual-feasible functions gives."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // size)
    # u_k rounds k+1 equal parts: f(x) = floor((k+1) x) / k, x/size whole multiples kept
    for k in range(1, 21):
        parts = (k + 1) * x
        value = np.where(parts % size == 0, x * k, (parts // size) * size)  # times k * size
        best = max(best, -(-int((count * value).sum()) // (k * size)))
    # threshold functions: items above size - t fill a bin, those below t count nothing
    own, total = np.cumsum(count), np.cumsum(count * x)
    half = size // 2
    t = np.arange(1, half + 1)
    big = own[size] - own[size - t]
    middle = total[size - t] - total[t - 1]
    best = max(best, int((big + -(-middle // size)).max()))
    # items above a half need a bin each; the rest of items of t and more share what those leave
    over = own[size] - own[half]
    room = over * size - (total[size] - total[half])
    return max(best, int(over), int(over + -(-max(0, int(total[half] - room)) // size)))


def best_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the room left in each bin: best-fit decreasing; equal lengths keep their order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_rooms: list[int] = []
    by_room: dict[int, list[int]] = {}
    room: list[int] = []
    for k in order:
        n = int(lengths[k])
        at = bisect_left(open_rooms, n)
        if at == len(open_rooms):
            chosen = len(room)
            room.append(size)
        else:
            had = open_rooms[at]
            held = by_room[had]
            chosen = held.pop()
            if not held:
                del by_room[had]
                open_rooms.pop(at)
        bins[k], offsets[k] = chosen, size - room[chosen]
        left = room[chosen] = room[chosen] - n
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(open_rooms, left)
            by_room[left].append(chosen)
    return bins, offsets, np.array(room, np.int64)


def pack(pieces: DataFrame, size: int = SIZE, per_partition: int = PER_PARTITION) -> DataFrame:
    """pieces (with a column `length`) and sequence_id, offset, certified; every piece once, no sequence above size.

    certified: the piece's partition used as few sequences as its lower bound, or its sequence is full.
    """
    table = cut(pieces.withColumn("__slot", F.monotonically_increasing_id()))
    waiting = table.select("__slot", F.col("length").cast("int").alias("length"))
    schema = "__slot long, length int, done boolean, certified boolean, part int, bin int, offset long"
    done: list[DataFrame] = []

    def packer(last: bool):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("__slot").reset_index(drop=True)
            lengths = group["length"].to_numpy()
            bins, offsets, room = best_fit(lengths, size)
            sure = np.full(len(room), True) if len(room) == lower_bound(lengths, size) else room == 0
            done = sure | last
            return group[["__slot", "length"]].assign(done=done[bins], certified=sure[bins], part=np.int32(key[0]), bin=bins.astype(np.int32), offset=offsets)

        return run

    left, before, step = waiting.count(), None, 0
    while left:
        parts = max(1, -(-left // per_partition))
        # nothing is gained any more where a round leaves nearly all that it was given
        last = parts == 1 or (before is not None and left > STALLED * before)
        dealt = waiting.withColumn("deal", F.pmod(F.xxhash64("__slot", F.lit(step)), F.lit(parts)).cast("int"))
        packed = cut(dealt.groupBy("deal").applyInPandas(packer(last), schema))
        done.append(packed.filter("done").select("__slot", (F.lit(step << 56) + F.col("part").cast("long") * F.lit(1 << 32) + F.col("bin")).alias("sequence_id"), "offset", "certified"))
        if last:
            break
        waiting = packed.filter("not done").select("__slot", "length")
        before, left, step = left, waiting.count(), step + 1
    if not done:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    # a shuffled join at every size: what the table carries (ids, in the pipeline) would else be broadcast while it is small
    return table.join(reduce(DataFrame.unionByName, done).hint("merge"), "__slot").drop("__slot")


def certificate(packed: DataFrame, size: int = SIZE) -> DataFrame:
    """One row: sequences, those in partitions (or full) that are proven minimal, and the bound that all tokens give."""
    by = packed.groupBy("sequence_id").agg(F.sum("length").alias("held"), F.first("certified").alias("certified"))
    return by.agg(F.count("*").alias("sequences"), F.count_if("certified").alias("certified"), F.ceil(F.sum("held") / size).alias("least"))

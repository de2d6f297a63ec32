"""Language-model scoring by prediction by partial matching (PPM).

A byte-context trie is learnt from training texts: for every context of up to `order` bytes the
counts of the bytes that follow. A text's score is its log10 probability, byte by byte and with an
end symbol. A byte that a context has not seen costs an escape (method C: distinct followers over
total plus distinct), after which the next shorter context is asked with the symbols of the longer
one excluded. Since a shorter context has seen whatever a longer one has, the excluded mass is a
property of the longer context; so the probability of a byte depends on its last order+1 bytes
only, and is worked out once for each distinct such gram of the corpus, in the trie's own joins.

The trie and the vocabulary grow with the corpus, so neither is collected nor broadcast. Texts are
packed into compressed blocks of some MB; a block lists its distinct words and grams, those keys
meet the global counts and scores in a shuffle, and one number for each goes back to the block,
which then scores its texts. Beside the trie the same exchange serves a smoothed unigram model over
words (`base`).

Defined results: a null text counts as empty (its tokens are the end alone); a null id counts as
training; repeated rows all count; with nothing to learn from, bytes are uniform; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import Words, crc_bucket, cut, drop

#: Bytes of the longest context; up to 6. A longer one costs distinct grams, of which each block exchanges a row.
ORDER = 3
END, PAD = 0xFE, 0xFF
SYMBOLS = 256
BLOCK_BYTES = 8 << 20
WORD, GRAM, TEXT = 0, 1, 2
#: Codes up to this number are told apart by a table, beyond by sorting.
TABLE = 1 << 26


def relabelled(codes: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, and each code's place among them."""
    if bound > TABLE:
        seen, at = np.unique(codes, return_inverse=True)
        return seen, at.astype(np.int32)
    table = np.zeros(bound, bool)
    table[codes] = True
    seen = np.flatnonzero(table)
    place = np.zeros(bound, np.int32)
    place[seen] = np.arange(len(seen), dtype=np.int32)
    return seen, place[codes]


#: Entries that are counted or summed at one time.
STEP = 1 << 20


class Numbered:
    """Texts as numbers: at names, symbol after symbol, one of the distinct keys; text k has sizes[k] symbols."""

    def __init__(self, keys: np.ndarray, at: np.ndarray, sizes: np.ndarray):
        self.keys, self.at, self.sizes = keys, at, sizes
        self.ends = np.cumsum(sizes)

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each key occurs in the chosen texts."""
        out = np.zeros(len(self.keys), np.int64)
        for a, b in self.steps():
            start = self.ends[a - 1] if a else 0
            out += np.bincount(self.at[start : self.ends[b - 1]][np.repeat(chosen[a:b], self.sizes[a:b])], minlength=len(out))
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of its symbols' values."""
        out = np.zeros(len(self.sizes), values.dtype)
        for a, b in self.steps():
            start = self.ends[a - 1] if a else 0
            out[a:b] = np.add.reduceat(values[self.at[start : self.ends[b - 1]]], self.ends[a:b] - self.sizes[a:b] - start)
        return out

    def steps(self) -> Iterator[tuple[int, int]]:
        """Texts in runs of about STEP symbols."""
        a, n = 0, len(self.sizes)
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.ends, (self.ends[a - 1] if a else 0) + STEP, side="right")))
            yield a, b
            a = b


def words_of(texts: pa.Array) -> Numbered:
    """Each text's words, A-Z lower-cased, and its end, which is a token too."""
    words = Words(pc.ascii_lower(texts))
    keys = np.append(words.hashes(), np.uint64(0)).view(np.int64)
    return Numbered(keys, np.insert(words.codes, words.starts[1:], len(keys) - 1), np.diff(words.starts) + 1)


def grams_of(texts: pa.Array, order: int) -> Numbered:
    """Each text's bytes and its end, each as the gram of it and the `order` bytes before it."""
    raw = [t.as_buffer() if t.is_valid else b"" for t in texts.cast(pa.binary())]
    sizes = np.array([len(t) + 1 for t in raw], np.int64)
    body = np.frombuffer(b"".join(x for t in raw for x in (bytes([PAD] * order), t, bytes([END]))), np.uint8)
    inside = np.ones(len(body), bool)
    starts = np.cumsum(sizes + order) - (sizes + order)
    for k in range(order):
        inside[starts + k] = False
    at = np.flatnonzero(inside).astype(np.int32)
    alphabet, dense = relabelled(body, 256)
    dense = dense.astype(np.uint8)
    label, grams = dense[at - order].astype(np.int32), alphabet.astype(np.int64)
    for k in range(order - 1, -1, -1):
        code = label if len(grams) * len(alphabet) < 1 << 31 else label.astype(np.int64)
        code *= code.dtype.type(len(alphabet))
        code += dense[at - k]
        seen, label = relabelled(code, len(grams) * len(alphabet))
        grams = (grams[seen // len(alphabet)] << 8) | alphabet[seen % len(alphabet)]
    return Numbered(grams, label, sizes)


def packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()


def texts_of(table: pa.Table) -> pa.Array:
    found = table["text"].combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def blocks(rows: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """(block, kind, key, at, n, body) of rows (id, text, train): a TEXT row for each block, WORD and GRAM rows for its distinct words and grams, numbered, with their training counts."""
    schema = "block long, kind int, key long, at int, n long, body binary"

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = uuid.uuid4().int >> 65
        table = pa.Table.from_batches(held).combine_chunks()
        train, texts = table["train"].to_numpy(), texts_of(table)

        def out(kind: int, keys: np.ndarray, counts: np.ndarray, body: bytes | None = None) -> pa.RecordBatch:
            n = len(keys)
            arrays = [pa.array(np.full(n, name, np.int64)), pa.array(np.full(n, kind, np.int32)), pa.array(keys), pa.array(np.arange(n, dtype=np.int32)), pa.array(counts.astype(np.int64)), pa.array([body] * n, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["block", "kind", "key", "at", "n", "body"])

        yield out(TEXT, np.zeros(1, np.int64), np.array([table.num_rows]), packed(table))
        for kind, own in ((WORD, words_of(texts)), (GRAM, grams_of(texts, order))):
            yield out(kind, own.keys, own.counts(train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                held.append(part)
                size += (pc.sum(pc.binary_length(part.column("text"))).as_py() or 0) + 64 * part.num_rows
                if size >= block_bytes:
                    yield from made(held)
                    held, size = [], 0
        if held:
            yield from made(held)

    return rows.mapInArrow(run, schema)


def suffix(key: str | Column, size: int) -> Column:
    """The last `size` bytes of a gram."""
    return (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit((1 << 8 * size) - 1))


def gram_scores(grams: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 probability of the last byte of each distinct gram of order+1 bytes, from rows (key, n)."""
    longest = cut(grams.groupBy("key").agg(F.sum("n").alias("count")))
    levels = {order + 1: longest.filter("count > 0")}
    for size in range(order, 0, -1):
        levels[size] = cut(levels[size + 1].groupBy(suffix("key", size).alias("key")).agg(F.sum("count").alias("count")))

    def contexts(size: int) -> DataFrame:
        """(context, total, distinct, excluded): what followed contexts of `size` bytes, and the count that those symbols have in the next shorter context."""
        own = levels[size + 1]
        if size:
            short = levels[size].select(F.col("key").alias("short"), F.col("count").alias("short_count"))
            own = own.withColumn("short", suffix("key", size)).join(short, "short")
        else:
            own = own.withColumn("short_count", F.lit(0).cast("long"))
        return own.groupBy(F.shiftright("key", 8).alias("context")).agg(F.sum("count").alias("total"), F.count("*").alias("distinct"), F.sum("short_count").alias("excluded"))

    stats = {size: cut(contexts(size)) for size in range(order, -1, -1)}
    share = lambda part, whole: F.log10(part / whole)
    seen = levels[order + 1].withColumn("context", F.shiftright("key", 8)).join(stats[order], "context").select("key", share(F.col("count"), F.col("total") + F.col("distinct")).alias("value"))
    # grams that training has not seen walk down the contexts; done: the level that has seen the byte
    zero = F.lit(0).cast("long")
    left = longest.filter("count = 0").select("key", F.lit(0.0).alias("value"), zero.alias("gone_total"), zero.alias("gone_distinct"), F.lit(False).alias("done"))
    for size in range(order, -1, -1):
        left = left.withColumn("context", suffix(F.shiftright("key", 8), size)).join(stats[size], "context", "left").drop("context")
        if size < order:
            node = levels[size + 1].select(F.col("key").alias("node"), "count")
            left = left.withColumn("node", suffix("key", size + 1)).join(node, "node", "left").drop("node")
        else:
            left = left.withColumn("count", zero)
        known, live = F.coalesce("distinct", zero), F.coalesce("distinct", zero) - F.col("gone_distinct")
        whole = F.coalesce("total", zero) - F.col("gone_total") + live
        count, asked = F.coalesce("count", zero), ~F.col("done") & (live > 0)
        more = F.when(asked & (count > 0), share(count, whole)).when(asked, share(live, whole)).otherwise(0.0)
        # what this context has seen is excluded from the next shorter one, which has seen it too
        left = left.select("key", (F.col("value") + more).alias("value"), F.when(known > 0, F.coalesce("excluded", zero)).otherwise(zero).alias("gone_total"), known.alias("gone_distinct"), (F.col("done") | (asked & (count > 0))).alias("done"))
    uniform = F.log10(F.greatest(F.lit(SYMBOLS) - F.col("gone_distinct"), F.lit(1)))
    unseen = left.select("key", F.when(F.col("done"), F.col("value")).otherwise(F.col("value") - uniform).alias("value"))
    done = cut(seen.unionByName(unseen))
    drop(longest, *levels.values(), *stats.values())
    return done


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes for each row; learns from rows that aren't held out."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    held = F.coalesce(held_out if held_out is not None else crc_bucket(F.col(f"`{id_col}`")) == 1, F.lit(False))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), (~held).alias("train"))
    kind = rows.schema["id"].dataType.simpleString()
    table = cut(blocks(rows, order, block_bytes))
    bodies = table.filter(F.col("kind") == TEXT).select("block", "body")
    words, grams = (table.filter(F.col("kind") == k).select("block", "key", "at", "n") for k in (WORD, GRAM))
    counts = cut(words.groupBy("key").agg(F.sum("n").alias("value")))
    n_known = counts.filter("value > 0").count()
    scores = gram_scores(grams, order)
    answer = lambda own, values: own.select("block", "key", "at").join(values.select("key", F.col("value").cast("double").alias("value")), "key").select(F.col("block").alias("of"), "at", "value")

    def run_words(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = unpacked(texts["body"][0].as_py())
        own = words_of(texts_of(rows))
        count = np.zeros(len(own.keys))
        count[answers["at"].to_numpy()] = answers["value"].to_numpy()
        return pa.table({"block": np.full(len(rows), key[0].as_py(), np.int64), "row": np.arange(len(rows)), "n_tokens": own.sizes, "n_known": own.sums((count > 0).astype(np.int64)), "logs": own.sums(np.log10(count + 0.5))})

    def run_grams(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = unpacked(texts["body"][0].as_py())
        own = grams_of(texts_of(rows), order)
        value = np.zeros(len(own.keys))
        value[answers["at"].to_numpy()] = answers["value"].to_numpy()
        return pa.table({"of": np.full(len(rows), key[0].as_py(), np.int64), "place": np.arange(len(rows)), "id": rows["id"], "train": rows["train"], "score": own.sums(value), "n_bytes": own.sizes - 1})

    # one after the other, so that only one of the two exchanges is on disk at a time
    by = lambda own, values: bodies.groupBy("block").cogroup(answer(own, values).groupBy("of"))
    by_word = cut(by(words, counts).applyInArrow(run_words, "block long, row long, n_tokens long, n_known long, logs double"))
    by_gram = cut(by(grams, scores).applyInArrow(run_grams, f"of long, place long, id {kind}, train boolean, score double, n_bytes long"))
    drop(table, counts, scores)
    scored = cut(by_gram.join(by_word, (F.col("of") == F.col("block")) & (F.col("place") == F.col("row"))))
    drop(by_word, by_gram)
    n_train = scored.agg(F.coalesce(F.sum(F.when(F.col("train"), F.col("n_tokens"))), F.lit(0))).first()[0]
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(n_train + 0.5 * (n_known + 1)))
    return scored.select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "n_bytes")


def bits_per_byte(scored: DataFrame) -> DataFrame:
    """held_out, bits a byte of both models, ends included: the length of the code that each needs."""
    bits = lambda c: (-F.sum(c) / F.log10(F.lit(2.0)) / F.sum(F.col("n_bytes") + 1)).alias(f"{c}_bits")
    return scored.groupBy("held_out").agg(bits("score"), bits("base_score"))

"""Near-duplicate detection by a chosen-path set similarity join.

A document is its set of five-word shingles; documents whose sets overlap by 75 % (Jaccard) are
linked, and a document's component is everything reachable over links.

1. `prepare` hashes shingles and takes `SIGNATURE` minwise tokens of each set. Equal sets form one
   class; only classes go on, so copies cost one row whatever their number.
2. Chosen paths: in each of `trees` independent trees a class walks down from the root; a node
   selects minwise coordinates (from its own hash) and a class branches by its tokens there. A node
   of at most `leaf` classes is compared exhaustively by sizes and sketches (a byte of each minwise
   token); what passes is confirmed on full shingle sets, each class's best candidate first, then
   those that still join different components.
3. Of a larger node every class first meets the node's centre, the class that lies in most large
   nodes (it shares the group's commonest tokens), and a second one drawn by hash: so a group of
   near copies becomes one component at a cost that is linear in the group.
4. Larger nodes that then hold one component are done: no link in them can change the result. In
   the others all classes outside of the node's commonest component are compared with all classes
   of the node, exactly, on full shingle sets, in blocks of bounded size (`blocks`). While that is
   more than `branch`^2 pairs and the node's children are at most half as large, it branches
   instead, on two coordinates: a pair of similarity J has 2 J > 1 children in common on average,
   so depth does not make it vanish (for J = 0.75 it lasts with probability 0.88 at any depth).
5. Components: alternating large-star and small-star steps until nothing changes.

So a pair of similarity J is found if it shares one node of the first level in any tree, be that
small or large: 1 - (1 - J)^trees, above 0.999999 for J = 0.75 and 10 trees (0.9999 where all its
nodes had to branch), times the sketch test in small nodes (4.5 standard deviations).

No group is collected into one task: large nodes are only aggregated, joined and dealt out in
blocks, links stay DataFrames, and every step is a table in the shared folder. A group of near
copies of one component costs a row for each class and tree. What costs more than that is a large
node whose classes are alike but not linked: classes outside its commonest component times its
size, in comparisons, not in rows.

Defined results: a null or empty text, or one without words, has no shingles and is its own
component; a text of fewer than five words is one shingle; rows that share an id are judged by
their own texts; a null id is never a component id unless all ids of a component are null, and
such rows are kept; an empty table gives an empty result; extra columns are ignored. Classes are
keyed by 64-bit hashes of 128-bit set digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena.llm.common import Words, annotate, cut, drop, mix64

WORDS = 5
#: Minwise tokens of a set; the first BRANCHING of them choose paths, the low bytes of all of them are the sketch.
SIGNATURE = 128
BRANCHING = 64
TREES = 10
LEAF = 48
#: A node is compared in blocks up to the square of this many pairs, or if its children are hardly smaller; else it branches.
BRANCH = 8_192
#: Shingles that one side of a block holds, on average.
BLOCK = 1_500_000
#: Least share of equal sketch bytes for a pair to be confirmed: 4.5 standard deviations below 0.75 at 128 coordinates.
ESTIMATE = 0.58
#: Least number of equal sketch bits, one a coordinate, of a pair that blocks compare: 4.5 deviations below what 0.75 gives.
BITS = 94
_rng = np.random.default_rng(20240607)
A = (_rng.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the five-word shingles of each text."""
    words = Words(pc.ascii_lower(texts))
    hashed = words.hashes()[words.codes]

    def codes_of(part: np.ndarray, size: int) -> np.ndarray:
        codes = np.full(len(part) - size + 1, size, np.uint64)
        for k in range(size):
            codes *= STEP
            codes += part[k : k + len(codes)]
        return mix64(codes)

    whole = codes_of(hashed, WORDS) if len(hashed) >= WORDS else None
    out = []
    for start, end in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True):
        n = end - start
        out.append(np.unique(whole[start : end - WORDS + 1]) if n >= WORDS else codes_of(hashed[start:end], n) if n else np.zeros(0, np.uint64))
    return out


def signature(codes: np.ndarray) -> np.ndarray:
    """Minwise tokens: for each coordinate the least of the shingle codes' 32-bit hashes."""
    low = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(codes), 4096):
        part = codes[at : at + 4096]
        low = np.minimum(low, ((part[None, :] * A[:, None]) >> np.uint64(32)).astype(np.uint32).min(axis=1))
    return low


def digest(codes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest() if len(codes) else None


def prepare(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text_key, n_shingles, class key, signature and sketch for each row. Rows of one id and text share (id, text_key)."""

    def worker():
        def run(texts: pa.Array) -> list:
            found = shingles(texts)
            low = [signature(codes) if len(codes) else None for codes in found]
            return [[len(codes) for codes in found], [digest(codes) for codes in found], [x if x is None else x[:BRANCHING].tobytes() for x in low], [x if x is None else x.astype(np.uint8).tobytes() for x in low]]

        return run

    text = F.col(f"`{text_col}`")
    made = annotate(df, {"id": F.col(f"`{id_col}`"), "text_key": F.xxhash64(text)}, text, worker, "n_shingles long, digest binary, sig binary, sketch binary")
    return made.withColumn("cls", F.when(F.col("digest").isNotNull(), F.xxhash64("digest"))).drop("digest")


def alike(pairs: DataFrame, least: float = ESTIMATE) -> DataFrame:
    """Pairs (a, b, sketch_a, sketch_b) as (a, b, share), where the share of equal sketch bytes reaches `least`; narrow."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left, right = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), SIGNATURE) for c in ("sketch_a", "sketch_b"))
                share = (left == right).mean(axis=1)
                keep = share >= least
                yield pd.DataFrame({"a": batch["a"][keep], "b": batch["b"][keep], "share": share[keep]})

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInPandas(run, "a long, b long, share double")


def near_in_size(a, b, similarity: int):
    return F.lit(100) * F.least(a, b) >= F.lit(similarity) * F.greatest(a, b)


def within_nodes(sized: DataFrame, facts: DataFrame, similarity: int, least: float = ESTIMATE) -> DataFrame:
    """Pairs (a, b, share) of each small node (cls, node) that sizes and sketches leave; nodes hold at most `leaf` classes."""
    held = sized.join(facts, "cls").groupBy("node").agg(*[F.collect_list(c).alias(c) for c in ("cls", "n", "sketch")]).select("cls", "n", "sketch").filter(F.size("cls") > 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            left, right, shares = [], [], []
            for keys, sizes, sketches in zip(batch["cls"], batch["n"], batch["sketch"], strict=True):
                m = len(keys)
                i, j = places.get(m) or places.setdefault(m, np.triu_indices(m, 1))
                n = np.asarray(sizes)
                fits = 100 * np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
                i, j = i[fits], j[fits]
                if len(i):
                    flat = np.frombuffer(b"".join(sketches), np.uint8).reshape(m, SIGNATURE)
                    share = (flat[i] == flat[j]).mean(axis=1)
                    keep = share >= least
                    left.append(np.asarray(keys)[i[keep]])
                    right.append(np.asarray(keys)[j[keep]])
                    shares.append(share[keep])
            if left:
                yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right), "share": np.concatenate(shares)})

    return held.mapInPandas(run, "a long, b long, share double")


def down(node: str, draw: int = 0):
    """The child of a node that a class's signature chooses."""
    step = F.substring("sig", F.pmod(F.xxhash64(node, F.lit(draw)), F.lit(BRANCHING)).cast("int") * 4 + 1, F.lit(4))
    return F.xxhash64(node, F.lit(draw), step)


def first_level(classes: DataFrame, trees: int, leaf: int) -> DataFrame:
    """(cls, tree, node, small) of the classes (cls, sig) whose node holds others too."""
    live = classes.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(trees)).cast("array<long>"))).select("cls", "tree", down("tree").alias("node"))
    # joined by (node, tree), not node alone: both sides then have a shuffle of their own, whose hot partitions AQE can split
    sizes = live.groupBy("node").agg(F.count("*").alias("size"), F.min("tree").alias("tree")).filter("size > 1")
    return live.join(sizes, ["node", "tree"]).select("cls", "tree", "node", (F.col("size") <= leaf).alias("small"))


def stars(large: DataFrame, facts: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b, share) of the classes of large nodes (cls, tree, node) with their nodes' centres."""
    weight = large.groupBy("cls").agg(F.count("*").alias("weight"))
    centre = large.join(weight, "cls").groupBy("node").agg(F.min("tree").alias("tree"), F.max(F.struct("weight", "cls")).alias("first"), F.max(F.struct(F.xxhash64("cls", "node").alias("draw"), "cls")).alias("second"))
    both = large.join(centre.select("node", "tree", F.col("first.cls").alias("first"), F.col("second.cls").alias("second")), ["node", "tree"])
    # the drawn one widens the choice; two trees of it are plenty
    met = both.select(F.col("cls").alias("a"), F.explode(F.when(F.col("tree") <= 2, F.array("first", "second")).otherwise(F.array("first"))).alias("b")).filter("a <> b").distinct()
    named = lambda side: facts.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
    return alike(met.join(named("a"), "a").join(named("b"), "b").filter(near_in_size(F.col("n_a"), F.col("n_b"), similarity)))


def mixed_nodes(rows: DataFrame) -> DataFrame:
    """(node, tree, m, outside, weight, weight_out, dominant) of the nodes in rows (cls, tree, node, root, n) that hold several components.

    outside: how many classes lie outside the node's commonest component; weights: the shingles of all, and of those.
    """
    homes = rows.groupBy("node", "root").agg(F.min("tree").alias("tree"), F.count("*").alias("held"), F.sum("n").alias("w"))
    whole = homes.groupBy("node").agg(F.min("tree").alias("tree"), F.sum("held").alias("m"), F.sum("w").alias("weight"), F.count("*").alias("homes"), F.max(F.struct("held", "root", "w")).alias("top"))
    return whole.filter("homes > 1").select("node", "tree", "m", (F.col("m") - F.col("top.held")).alias("outside"), "weight", (F.col("weight") - F.col("top.w")).alias("weight_out"), F.col("top.root").alias("dominant"))


def open_nodes(large: DataFrame, classes: DataFrame, roots: DataFrame, branch: int, most: int = 64) -> tuple[DataFrame, bool]:
    """A table (cls, tree, node, root, n, and what mixed_nodes says) of the nodes to be compared in blocks; and whether nodes had to branch.

    `most` ends the branching, not the search: what is still large then is compared as it is.
    """
    homes = classes.select("cls", "n").join(roots, "cls", "left").select("cls", "n", F.coalesce("root", "cls").alias("root"))
    rows = cut(large.select("cls", "tree", "node").join(homes, "cls"))
    ready, scraps, branched = [], [rows], False
    for _ in range(most):
        nodes = cut(mixed_nodes(rows))
        scraps.append(nodes)
        wide = nodes.filter(F.col("outside") * F.col("m") > F.lit(branch * branch))
        if wide.isEmpty():
            break
        held = rows.join(wide.select("node", "tree", "m"), ["node", "tree"]).join(classes.select("cls", "sig"), "cls")
        below = cut(held.select("cls", "root", "n", "tree", F.col("node").alias("parent"), "m", F.explode(F.array(down("node", 1), down("node", 2))).alias("node")))
        sizes = below.groupBy("parent", "node").agg(F.min("tree").alias("tree"), F.count("*").alias("size"), F.first("m").alias("m"))
        shrinks = cut(sizes.groupBy("parent").agg(F.min("tree").alias("tree"), F.max("size").alias("largest"), F.first("m").alias("m")).filter("2 * largest <= m").select("parent", "tree"))
        scraps += [below, shrinks]
        if shrinks.isEmpty():
            break
        branched = True
        ready.append(rows.join(nodes.join(shrinks.select(F.col("parent").alias("node"), "tree"), ["node", "tree"], "left_anti"), ["node", "tree"]))
        rows = cut(below.join(shrinks, ["parent", "tree"]).select("cls", "tree", "node", "root", "n"))
        scraps.append(rows)
    work = cut(reduce(DataFrame.unionByName, [*ready, rows.join(mixed_nodes(rows), ["node", "tree"])]))
    drop(*scraps)
    return work, branched


def blocks(work: DataFrame, held: DataFrame, trees: int, first_only: bool, similarity: int, block: int) -> DataFrame:
    """Links (a, b), enough to join what is linked, between classes of different components of a node, compared completely.

    work: rows of open_nodes; held: (cls, sig, sketch, codes). A node's classes are dealt into parts of about `block`
    shingles, those outside the commonest component also into parts of their own; each pair of such parts is a block.
    first_only: a pair is compared in the first tree only in which it shares a node of the first level.
    """
    out = F.col("root") != F.col("dominant")
    parts = lambda w: F.ceil(F.col(w) / F.lit(block)).cast("long")
    dealt = work.withColumns({"n_all": parts("weight"), "n_out": parts("weight_out")}).withColumn("draw", F.xxhash64("cls", "node"))
    all_side = dealt.select("cls", "tree", "node", "root", "n", F.lit(False).alias("out"), F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_out") - 1), lambda k: F.struct(k.alias("i"), F.pmod("draw", "n_all").alias("j")))).alias("at"))
    out_side = dealt.filter(out).select("cls", "tree", "node", "root", "n", F.lit(True).alias("out"), F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_all") - 1), lambda k: F.struct(F.pmod("draw", "n_out").alias("i"), k.alias("j")))).alias("at"))
    rows = all_side.unionByName(out_side).select("cls", "tree", "node", "root", "n", "out", F.col("at.i").alias("i"), F.col("at.j").alias("j"))
    tokens = F.concat(*[F.substring("sig", F.pmod(F.xxhash64(F.lit(t).cast("long"), F.lit(0)), F.lit(BRANCHING)).cast("int") * 4 + 1, F.lit(4)) for t in range(1, trees + 1)])
    full = rows.join(held.select("cls", tokens.alias("tokens"), "sketch", "codes"), "cls")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["out"]], group[~group["out"]]
        found = linked(left, right, int(group["tree"].iloc[0]) if first_only else 1, similarity)
        return pd.DataFrame(found, columns=["a", "b"])

    return full.groupBy("node", "i", "j").applyInPandas(run, "a long, b long")


def linked(left: pd.DataFrame, right: pd.DataFrame, tree: int, similarity: int) -> list[tuple[int, int]]:
    """Links between rows of left and right of different roots; once two roots are linked, no more between them."""
    if not len(left) or not len(right):
        return []
    arrays = [np.frombuffer(c, np.uint64) for c in [*left["codes"], *right["codes"]]]
    _, numbers = np.unique(np.concatenate(arrays), return_inverse=True)
    numbers = numbers.astype(np.int32)
    ends = np.cumsum([len(c) for c in arrays])
    codes = np.split(numbers, ends[:-1])
    mine, theirs = codes[: len(left)], codes[len(left) :]
    mark = np.zeros(int(numbers.max()) + 1, bool)
    names, labels = np.unique(np.concatenate([left["root"], right["root"]]), return_inverse=True)
    label_a, label_b = labels[: len(left)], labels[len(left) :]
    key_a, key_b = left["cls"].to_numpy(), right["cls"].to_numpy()
    n_a, n_b = left["n"].to_numpy(), right["n"].to_numpy()
    bits = lambda side: np.packbits(np.frombuffer(b"".join(side["sketch"]), np.uint8).reshape(len(side), SIGNATURE) & 1, axis=1).view(np.uint64)
    bits_a, bits_b = bits(left), bits(right)
    token = lambda side: np.frombuffer(b"".join(side["tokens"]), np.uint32).reshape(len(side), -1)[:, : tree - 1]
    token_a, token_b = token(left), token(right)
    out = []
    for k in range(len(left)):
        fits = (label_b != label_a[k]) & (100 * np.minimum(n_b, n_a[k]) >= similarity * np.maximum(n_b, n_a[k]))
        fits &= SIGNATURE - np.bitwise_count(bits_b ^ bits_a[k]).sum(axis=1) >= BITS
        if tree > 1:
            fits &= ~(token_b == token_a[k]).any(axis=1)
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        own = [theirs[j] for j in at]
        starts = np.cumsum([0, *map(len, own[:-1])])
        mark[mine[k]] = True
        shared = np.add.reduceat(mark[np.concatenate(own)], starts, dtype=np.int64)
        mark[mine[k]] = False
        for j in at[100 * shared >= similarity * (n_a[k] + n_b[at] - shared)]:
            if label_b[j] != label_a[k]:
                out.append((int(key_a[k]), int(key_b[j])))
                gone, stays = label_b[j], label_a[k]
                label_a[label_a == gone] = stays
                label_b[label_b == gone] = stays
    return out


def class_texts(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, repeated: bool, as_codes: bool = False) -> DataFrame:
    """(cls, text), or with as_codes (cls, codes: the shingle set), one for each wanted class (cls, rep), found through the row that represents it.

    repeated: whether some rows have id and text in common; those are to be made one.
    """
    text = F.col(f"`{text_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text.cast("string").alias("text"), F.xxhash64(text).alias("text_key")).filter("text is not null")
    reps = wanted.select("cls", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    met = rows.join(reps, (F.col("text_key") == F.col("rep_key")) & F.col("id").eqNullSafe(F.col("rep_id"))).select("cls", "text")

    def worker():
        def run(texts: pa.Array) -> list:
            found = shingles(texts)
            return [[digest(c) for c in found], [c.tobytes() for c in found] if as_codes else texts]

        return run

    kept, name = ("codes", "codes") if as_codes else ("kept_text", "text")
    checked = annotate(met, {"cls": F.col("cls")}, F.col("text"), worker, f"digest binary, {kept} {'binary' if as_codes else 'string'}").filter(F.xxhash64("digest") == F.col("cls"))
    return checked.groupBy("cls").agg(F.first(kept).alias(name)) if repeated else checked.select("cls", F.col(kept).alias(name))


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: int = 75) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity, in per cent."""
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                # a text that stands in several pairs is read once
                coded = [batch.column(c).dictionary_encode() for c in ("text_a", "text_b")]
                sets = [shingles(c.dictionary) for c in coded]
                keep = []
                for i, j in zip(*(c.indices.to_pylist() for c in coded), strict=True):
                    left, right = sets[0][i], sets[1][j]
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * shared >= similarity * (len(left) + len(right) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(cls, root) for every class with an edge (a, b): root is the least class reachable."""
    edges = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        below = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = below.groupBy("u").agg(F.min("v").alias("m"))
        small = below.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        last, edges = edges, cut(small)
        drop(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("cls"), "root")
    done = cut(roots.unionByName(roots.select(F.col("root").alias("cls"), "root").distinct()))
    drop(edges)
    return done


def classified(df: DataFrame, id_col: str, text_col: str, similarity: int = 75, trees: int = TREES, leaf: int = LEAF, branch: int = BRANCH, block: int = BLOCK) -> DataFrame:
    """id, text_key, n_shingles, cls, and of the row's component chosen (id, text_key): its least row; null without words."""
    rows = cut(prepare(df, id_col, text_col))
    repeated = not rows.filter("cls is not null").groupBy("id", "text_key").count().filter("count > 1").isEmpty()
    least_row = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key"))
    classes = cut(rows.filter("cls is not null").groupBy("cls").agg(least_row.alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")))
    facts = classes.select("cls", "n", "sketch")
    placed = cut(first_level(classes, trees, leaf))
    large = placed.filter("not small")
    near = cut(within_nodes(placed.filter("small").select("cls", "node"), facts, similarity).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "share").distinct())
    any_large = not large.isEmpty()
    star = cut(stars(large, facts, similarity)) if any_large else None
    # known components are stars already: new links join those
    joined = lambda roots, links: roots.select(F.col("cls").alias("a"), F.col("root").alias("b")).unionByName(links)
    # first round: the best candidate of each class
    pairs = near if star is None else near.unionByName(star)
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "share"))
    best = cut(sides.groupBy("a").agg(F.max(F.struct("share", "b")).alias("best")).select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    texts = cut(class_texts(df, id_col, text_col, classes.select("cls", "rep").join(ends, "cls", "left_semi"), repeated))
    roots = components(confirmed(best, texts, similarity))
    # second round: whatever of small nodes still leads to another component; large nodes are compared below
    marked = near.join(best, ["a", "b"], "left_anti").select("a", "b").join(roots.select(F.col("cls").alias("a"), F.col("root").alias("root_a")), "a", "left").join(roots.select(F.col("cls").alias("b"), F.col("root").alias("root_b")), "b", "left")
    apart = cut(marked.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))
    if not apart.isEmpty():
        roots, last = components(joined(roots, confirmed(apart, texts, similarity))), roots
        drop(last)
    drop(near, star, best, apart, texts)
    if any_large:
        work, branched = open_nodes(large, classes, roots, branch)
        if not work.isEmpty():
            ids = classes.select("cls", "rep").join(work.select("cls").distinct(), "cls", "left_semi")
            held = cut(class_texts(df, id_col, text_col, ids, repeated, as_codes=True).join(classes.select("cls", "sig", "sketch"), "cls"))
            links = cut(blocks(work, held, trees, not branched, similarity, block))
            roots, last = components(joined(roots, links)), roots
            drop(held, links, last)
        drop(work)
    named = roots.join(classes.select("cls", "rep"), "cls")
    least = named.groupBy("root").agg(F.min("rep").alias("chosen"))
    home = named.join(least, "root").select("cls", "chosen")
    final = classes.select("cls", "rep").join(home, "cls", "left").select("cls", F.coalesce("chosen", "rep").alias("chosen"))
    done = cut(rows.select("id", "text_key", "n_shingles", "cls").join(final, "cls", "left"))
    drop(rows, classes, placed, roots)
    return done


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_shingles, component_id, kept for each row. Options: those of classified()."""
    rows = classified(df, id_col, text_col, **options)
    home = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("chosen.id"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", home.alias("component_id"), F.col("id").eqNullSafe(home).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df that stay, with df's columns: of each component the rows' least (id, text), once; rows without words all stay."""
    rows = classified(df, id_col, text_col, **options).filter("cls is not null")
    stays = F.col("id").eqNullSafe(F.col("chosen.id")) & (F.col("text_key") == F.col("chosen.text_key"))
    keys = rows.groupBy("id", "text_key").agg(F.first(stays).alias("stays"), F.count("*").alias("times")).filter("not stays or times > 1")
    other = cut(keys.select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.when(F.col("stays"), F.col("times")).alias("__times")))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__key"))
    once = df.join(other, same, "left_anti")
    repeated = df.join(other.filter("__times is not null"), same).dropDuplicates(["__id", "__key"]).select(*[F.col(f"`{c}`") for c in df.columns])
    return once.unionByName(repeated)

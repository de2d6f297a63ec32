"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of template tokens: A-Z lower-cased words without edge
punctuation, in which numbers, names (capitalised words inside a sentence) and units turn into the
typed placeholders <num>, <name>, <unit>. Windows of `window` template tokens are hashed and joined
with those of the benchmark. A hit must then be slot-consistent: over the windows that a document
shares with an item, each slot value of the item stands for one value in the document (two of them
may stand for the same one); windows over slots that break this are dropped (a slot with the item's
own value breaks nothing). So a question with other numbers or names is caught. Against chance
meetings of placeholder-rich windows, a share of `min_plain` of the covered tokens must be words.

A capitalised word that starts a line or sentence may be a name or not: it has both forms. In the
benchmark a window has every choice of forms for up to three such words, and for more of them those with
none, one, all but one or all as names, so windows stay at most 2 * `window` + 2 times the tokens; in
documents all such words are plain or all are names. A word that is a name inside a sentence of any item is one everywhere, whatever its case.

A document is contaminated by an item if consistent windows cover `min_share` of the item's
template tokens and at least min(len(item), `min_tokens`) of them, or `min_run` tokens in a row.
The parts of a passage on the sides of inserted or deleted words add up: windows at different
alignments count together while they follow each other within the item's length.

The benchmark's windows are broadcast only while they number at most `max_broadcast` (16 bytes
each); beyond, windows of documents and items meet in a shuffled join. Both ways feed the same
check.

Defined results: null and empty texts match nothing; items with fewer tokens than `window` use one
window of their whole length, null or empty items none; repeated documents are judged row by row;
repeated items are distinct items by id; a null document id is carried through; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provena.llm.common import LOWER, UPPER, Words, annotate, columns, cut, drop, mix64

WINDOW = 8
MAX_BROADCAST = 2_000_000
#: Stands for a line break among words.
LINE = "\ue0f1"
FOLD = str.maketrans(UPPER, LOWER)
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*%?$|\d+(?:st|nd|rd|th)$")
#: Number words and units in English, German, French and Spanish, without those that are common words of another kind.
NUMBER_WORDS = frozenset((
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig hundert tausend "
    "deux trois quatre cinq sept huit neuf dix onze douze vingt trente quarante cinquante cent mille "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce veinte treinta cuarenta cincuenta cien mil"
).split())
UNITS = frozenset((
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds ounce ounces ml l liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours hr day days week weeks month months year years dollar dollars cents euro euros percent degrees mph km/h "
    "meter metern kilometer gramm kilogramm sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren prozent "
    "mètre mètres kilomètre kilomètres gramme grammes kilogrammes heure heures jour jours semaine semaines mois années centimes "
    "metro metros kilómetro kilómetros gramo gramos kilogramos litros segundo segundos minuto minutos hora horas día días semana semanas meses año años euros céntimos"
).split())
EDGE = "\"'“”‘’«»()[]{}.,;:!?¡¿…*_-"
KINDS = ("<num>", "<name>", "<unit>")
CACHE = 300_000


@dataclass(frozen=True)
class Rules:
    """When covered tokens of an item contaminate a document."""

    min_share: float = 0.5
    min_tokens: int = 12
    min_run: int = 13
    min_plain: float = 0.3


class Parts:
    """Texts as template tokens, one after the other: template hashes, values (hashes of the words), slot kinds (0: none), which plain tokens may also be names; and where each text starts."""

    def __init__(self, template: np.ndarray, value: np.ndarray, kind: np.ndarray, either: np.ndarray, starts: np.ndarray):
        self.template, self.value, self.kind, self.either, self.starts = template, value, kind, either, starts

    def __len__(self) -> int:
        return len(self.value)

    def text(self, k: int) -> Parts:
        own = slice(self.starts[k], self.starts[k + 1])
        return Parts(self.template[own], self.value[own], self.kind[own], self.either[own], np.array([0, self.starts[k + 1] - self.starts[k]]))


class Template:
    """Template tokens of texts; words that were met are remembered. names: hashes of words that are names in any place and case."""

    def __init__(self, names: frozenset[int] = frozenset()) -> None:
        self.names = names
        self.known: dict[str, tuple[int, int]] = {}
        self.slots = [xxhash.xxh64_intdigest(k) for k in KINDS]

    def word(self, word: str) -> tuple[int, int]:
        """Hash of the lower-cased word; its kind (0 plain, 1 number, 2 capitalised, 3 unit, 4 of the names), 8 more if it ends a sentence."""
        bare = word.strip(EDGE) or word
        low = bare.translate(FOLD)
        kind = 1 if NUMBER.match(bare) or low in NUMBER_WORDS else 3 if low in UNITS else 2 if bare[:1].isupper() and bare[1:].islower() else 0
        value = xxhash.xxh64_intdigest(low)
        kind = 4 if kind in (0, 2) and value in self.names else kind
        return value, kind + 8 * (word[-1:] in ".!?:;…" or word.endswith((".\"", ".”", "!”", "?”")))

    def of(self, texts: pa.Array) -> Parts:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        # line breaks become words of their own
        words = Words(pc.replace_substring(pc.replace_substring(texts, LINE, "\ufffd"), "\n", f" {LINE} "))
        vocabulary = words.vocabulary.to_pylist()
        for w in vocabulary:
            if w not in known:
                known[w] = self.word(w)
        found = [known[w] for w in vocabulary]
        line = np.fromiter((w == LINE for w in vocabulary), bool, len(vocabulary))[words.codes]
        before = np.zeros(len(words.codes), bool)
        before[1:] = line[:-1]
        before[words.starts[:-1][words.starts[:-1] < len(before)]] = True
        starts = np.concatenate([[0], np.cumsum(~line)])[words.starts]
        codes, first = words.codes[~line], before[~line]
        value = np.fromiter((v for v, _ in found), np.uint64, len(found))[codes]
        coded = np.fromiter((k for _, k in found), np.int8, len(found))[codes]
        kind = coded & 7
        first[1:] |= coded[:-1] >= 8
        either = (kind == 2) & first
        kind[either] = 0
        kind[kind == 4] = 2
        template = value.copy()
        for k, code in enumerate(self.slots, 1):
            template[kind == k] = code
        return Parts(template, value, kind, either, starts)

    def as_names(self, template: np.ndarray, either: np.ndarray) -> np.ndarray:
        return np.where(either, np.uint64(self.slots[1]), template)


def windows(template: np.ndarray, size: int) -> np.ndarray:
    n = len(template) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    codes = np.zeros(n, np.uint64)
    for k in range(size):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + template[k : k + n]
    return mix64(codes + np.uint64(size))


def own_names(text: str | None) -> set[int]:
    """Values of the names inside the sentences of an item."""
    parts = Template().of(pa.array([text], pa.string()))
    return set(parts.value[parts.kind == 2].tolist())


def near_either(either: np.ndarray, size: int) -> np.ndarray:
    """Places of the windows that hold a token of two forms."""
    total = np.concatenate([[0], np.cumsum(either)])
    return np.flatnonzero(total[size:] > total[:-size]) if len(either) >= size else np.zeros(0, int)


def doc_windows(make: Template, parts: Parts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and places of the windows inside texts, with the words of two forms all plain and all names."""
    codes = windows(parts.template, size)
    at = near_either(parts.either, size)
    if len(at):
        named = windows(make.as_names(parts.template, parts.either), size)[at]
        codes, at = np.concatenate([codes, named]), np.concatenate([np.arange(len(codes)), at])
    else:
        at = np.arange(len(codes))
    if len(parts.starts) == 2:
        return codes, at
    inside = at + size <= parts.starts[np.searchsorted(parts.starts, at, side="right")] if len(at) else np.zeros(0, bool)
    return codes[inside], at[inside]


def choices(k: int) -> np.ndarray:
    """Which of k words of two forms are names: none, one, all but one, or all. With up to three words that is every choice; at most 2 k + 2 in all."""
    one = np.eye(k, dtype=bool)
    return np.unique(np.concatenate([np.zeros((1, k), bool), one, ~one, np.ones((1, k), bool)]), axis=0)


def item_windows(make: Template, parts: Parts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and places of an item's windows, with the choices for the words of two forms."""
    codes, places = [windows(parts.template, size)], [np.arange(len(parts) - size + 1)]
    named = make.as_names(parts.template, parts.either)
    for at in near_either(parts.either, size).tolist():
        open_ = np.flatnonzero(parts.either[at : at + size])
        for choice in choices(len(open_)):
            if choice.any():
                part = parts.template[at : at + size].copy()
                use = open_[choice]
                part[use] = named[at + use]
                codes.append(windows(part, size))
                places.append(np.array([at]))
    return np.concatenate(codes), np.concatenate(places)


def count_windows(items: DataFrame, window: int) -> int:
    """How many windows the texts of items have; without their common names, which can only make it less."""

    def worker():
        make = Template()

        def run(texts: pa.Array) -> list:
            parts = make.of(texts)
            own = [parts.text(k) for k in range(len(texts))]
            return [[len(item_windows(make, p, min(window, len(p)))[0]) if len(p) else 0 for p in own]]

        return run

    return annotate(items, {}, F.col("text"), worker, "n long").agg(F.sum("n")).first()[0] or 0


class Items:
    """The benchmark in template form, with an index of its windows. Items are numbered as they come."""

    def __init__(self, texts: Sequence[str | None], window: int, names: frozenset[int] | None = None):
        self.make = make = Template(frozenset().union(*map(own_names, texts)) if names is None else names)
        self.parts: list[tuple[Parts, int]] = []
        codes, owner, place = [np.zeros(0, np.uint64)], [np.zeros(0, int)], [np.zeros(0, int)]
        for k, text in enumerate(texts):
            parts = make.of(pa.array([text], pa.string())).text(0)
            size = min(window, len(parts))
            self.parts.append((parts, size))
            if size:
                found, at = item_windows(make, parts, size)
                codes.append(found)
                owner.append(np.full(len(found), k))
                place.append(at)
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        self.codes, self.owner, self.place = flat[order], np.concatenate(owner)[order], np.concatenate(place)[order]
        self.size = np.array([size for _, size in self.parts], int)
        self.sizes = sorted(set(self.size.tolist()) - {0})
        #: Low bits of the codes: most windows of documents end here.
        self.bits = np.uint64((1 << max(16, (8 * len(flat)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.bits) + 1, bool)
        self.maybe[(flat & self.bits).astype(np.int64)] = True

    def hits(self, parts: Parts) -> np.ndarray:
        """Distinct rows (text, item, place in the document, place in the item) of the windows that texts and items have in common."""
        out = [np.zeros((0, 4), np.int64)]
        for size in self.sizes:
            codes, places = doc_windows(self.make, parts, size)
            some = np.flatnonzero(self.maybe[(codes & self.bits).astype(np.int64)])
            codes, places = codes[some], places[some]
            low, high = np.searchsorted(self.codes, codes), np.searchsorted(self.codes, codes, side="right")
            n = high - low
            row = np.repeat(np.arange(len(n)), n)
            entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(row))
            own = self.size[self.owner[entry]] == size
            at, entry = places[row[own]], entry[own]
            text = np.searchsorted(parts.starts, at, side="right") - 1
            out.append(np.stack([text, self.owner[entry], at - parts.starts[text], self.place[entry]], axis=1))
        return np.unique(np.concatenate(out), axis=0)

    def matches(self, parts: Parts, rules: Rules) -> list[list[tuple[int, int]]]:
        """For each text (item, tokens covered) of the items that contaminate it."""
        found: list[list[tuple[int, int]]] = [[] for _ in range(len(parts.starts) - 1)]
        hits = self.hits(parts)
        if not len(hits):
            return found
        bounds = np.flatnonzero(np.concatenate([[True], (hits[1:, :2] != hits[:-1, :2]).any(axis=1), [True]]))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            text, item = hits[a, :2].tolist()
            own, size = self.parts[item]
            whole = len(own)
            if (b - a) * size < min(whole, rules.min_tokens, rules.min_run):
                continue  # too few windows to cover enough
            n, run, plain = covered(own, size, parts.text(text), hits[a:b, 2:].tolist())
            if plain >= rules.min_plain * n and ((n >= rules.min_share * whole and n >= min(whole, rules.min_tokens)) or run >= rules.min_run):
                found[text].append((item, n))
        return found


def covered(item: Parts, size: int, doc: Parts, hits: list[list[int]]) -> tuple[int, int, int]:
    """Most tokens of the item that consistent windows cover in one stretch of the document, the longest run of them at one alignment, and how many of the tokens are plain; hits: (place in the document, in the item)."""
    stretches: list[list[list[int]]] = []
    for hit in sorted(hits):
        if not stretches or hit[0] - stretches[-1][-1][0] > len(item):
            stretches.append([])
        stretches[-1].append(hit)
    most, longest, best = 0, 0, set()
    for stretch in stretches:
        shifts: dict[int, list[int]] = {}
        for at, place in stretch:
            shifts.setdefault(at - place, []).append(place)
        bound: dict[tuple, tuple] = {}
        tokens: set[int] = set()
        # the alignment with most windows settles what slots stand for
        for shift, places in sorted(shifts.items(), key=lambda x: (-len(x[1]), x[0])):
            own = consistent(item, size, doc, places, shift, bound)
            tokens |= own
            run, last = 0, None
            for t in sorted(own):
                run = run + 1 if last == t - 1 else 1
                longest, last = max(longest, run), t
        if len(tokens) > most:
            most, best = len(tokens), tokens
    return most, longest, sum(item.kind[t] == 0 for t in best)


def consistent(item: Parts, size: int, doc: Parts, places: Sequence[int], shift: int, bound: dict[tuple, tuple]) -> set[int]:
    """The item's tokens in its windows at `places` whose slot values each stand for one value of the document, also by the map in `bound`, which grows."""
    pairs = {}
    for t in {t for p in places for t in range(p, p + size)}:
        kind = 2 if item.either[t] else int(item.kind[t])
        if kind:
            pairs[t] = (kind, int(item.value[t])), (kind, int(doc.value[t + shift]))
    there = {a: {b} for a, b in bound.items()}
    for a, b in pairs.values():
        there.setdefault(a, set()).add(b)
    broken = {t for t, (a, b) in pairs.items() if a != b and len(there[a]) > 1}
    kept = {t for p in places if broken.isdisjoint(range(p, p + size)) for t in range(p, p + size)}
    for t in kept & pairs.keys():
        bound.setdefault(*pairs[t])
    return kept


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_broadcast: int = MAX_BROADCAST, rules: Rules = Rules()) -> DataFrame:
    """id, item_ids, n_tokens (of the best item) for each row; item_ids is empty for clean rows."""
    return _matches(docs, columns(docs, [id_col]), F.col(f"`{text_col}`"), benchmark, item_col, item_text_col, window, max_broadcast, rules)


def _matches(docs: DataFrame, carry: Mapping[str, Column], text: Column, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_broadcast: int = MAX_BROADCAST, rules: Rules = Rules()) -> DataFrame:
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).filter("item is not null and text is not null")
    kind = items.schema["item"].dataType.simpleString()
    if count_windows(items, window) > max_broadcast:
        return _joined(docs, carry, text, items, window, rules)
    rows = items.orderBy("item").collect()
    held = docs.sparkSession.sparkContext.broadcast((Items([r["text"] for r in rows], window), [r["item"] for r in rows]))

    def worker():
        known, keys = held.value
        make = Template(known.make.names)

        def run(texts: pa.Array) -> list:
            found = known.matches(make.of(texts), rules)
            return [[[keys[k] for k, _ in f] for f in found], [max((n for _, n in f), default=0) for f in found]]

        return run

    return annotate(docs, carry, text, worker, f"item_ids array<{kind}>, n_tokens long")


def _joined(docs: DataFrame, carry: Mapping[str, Column], text: Column, items: DataFrame, window: int, rules: Rules) -> DataFrame:
    """The way for benchmarks too large to broadcast: windows meet in a shuffled join, then each document is checked against the items it met.

    Documents emit windows of the lengths that items have; a document and item meet once, however many windows they share.
    """
    spark, kind = docs.sparkSession, items.schema["item"].dataType.simpleString()

    def sized():
        def run(texts: pa.Array) -> list:
            named = [sorted(own_names(t)) for t in texts.to_pylist()]
            return [[np.array(n, np.uint64).view(np.int64).tolist() for n in named], np.diff(Template().of(texts).starts).clip(max=window)]

        return run

    # a vocabulary and at most `window` lengths: they grow far slower than the benchmark
    about = cut(annotate(items, {}, F.col("text"), sized, "names array<long>, size int"))
    names = spark.sparkContext.broadcast(frozenset(r["name"] % (1 << 64) for r in about.select(F.explode("names").alias("name")).distinct().collect()))
    sizes = sorted(r["size"] for r in about.filter("size > 0").select("size").distinct().collect())
    drop(about)

    def coded(of_items: bool):
        def worker():
            make = Template(names.value)

            def run(texts: pa.Array) -> list:
                parts, out = make.of(texts), []
                for k in range(len(texts)):
                    own = parts.text(k)
                    wanted = [min(window, len(own))] if of_items else [z for z in sizes if z <= len(own)]
                    codes = [(item_windows if of_items else doc_windows)(make, own, z)[0] for z in wanted if z]
                    out.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *codes])).view(np.int64).tolist())
                return [out]

            return run

        return worker

    text_key = F.xxhash64(text)
    texts = cut(docs.select(text_key.alias("key"), text.cast("string").alias("body")).filter("body is not null").dropDuplicates(["key", "body"]))
    left = annotate(texts, {"key": F.col("key")}, F.col("body"), coded(False), "codes array<long>").select("key", F.explode("codes").alias("code"))
    right = annotate(items, {"item": F.col("item")}, F.col("text"), coded(True), "codes array<long>").select("item", F.explode("codes").alias("code"))
    pairs = left.join(right, "code").select("key", "item").distinct()
    met = pairs.join(items.withColumnRenamed("text", "item_text"), "item").join(texts, "key")

    def check():
        make = Template(names.value)
        built: dict[str, Items] = {}

        def run(both: pa.Array) -> list:
            out = []
            for pair in both.to_pylist():
                n = int(pair[:9])
                item, body = pair[9 : 9 + n], pair[9 + n :]
                if item not in built:
                    built.clear()
                    built[item] = Items([item], window, names.value)
                out.append(next((n for _, n in built[item].matches(make.of(pa.array([body], pa.string())), rules)[0]), None))
            return [out]

        return run

    both = F.concat(F.lpad(F.length("item_text").cast("string"), 9, "0"), "item_text", "body")
    found = annotate(met.select("key", "body", "item", "item_text"), columns(met, ["key", "body", "item"]), both, check, "n long").filter("n is not null")
    found = found.groupBy("key", "body").agg(F.array_sort(F.collect_set("item")).alias("__items"), F.max("n").alias("__n"))
    wide = docs.select(*[c.alias(f"in_{k}") for k, c in enumerate(carry.values())], text_key.alias("__key"), text.cast("string").alias("__body"))
    joined = wide.join(found, (F.col("__key") == F.col("key")) & (F.col("__body") == F.col("body")), "left")
    return joined.select(*[F.col(f"in_{k}").alias(c) for k, c in enumerate(carry)], F.coalesce("__items", F.expr(f"cast(array() as array<{kind}>)")).alias("item_ids"), F.coalesce("__n", F.lit(0)).alias("n_tokens"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that no item contaminates, with docs' columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _matches(docs, {"__row": row}, F.col(f"`{text_col}`"), benchmark, **options).filter(F.size("item_ids") == 0).select("__row.*")

"""Benchmark decontamination by template canonicalisation.

Words of benchmark items and documents are canonicalised: numbers, units behind numbers and names become
typed placeholders, other words their lower case.  Windows of the resulting templates are hash-joined, and
the values in the placeholders' slots are compared: one benchmark value must stand for one document value
and the other way round.  So a question asked again with other numbers or names is caught, and texts that
merely share a frame of placeholders are not.  Windows of the words as they stand, whatever they are, are joined
beside the templates, so that no copy word for word is lost to its slots.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

WINDOW = 8
#: Plain words that a template has at least, whatever its length, to be searched with other values in its slots.
PLAIN_WORDS = 2
#: Bits for each item window of the filter that lets document windows through to the join, and the most of all.
#: The broadcast is 16 MB at most; beyond it more windows reach the join, which is exact.
WINDOW_BITS, LEAST_BITS, MOST_BITS = 24, 1 << 16, 1 << 27
PROBES = 3
#: Units, whole words in lower case.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ounce ounces pound pounds"
    " ton tons tonne tonnes ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr"
    " hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent"
    " mph kmh km/h kph w kw kwh v mv a ma hz khz mhz ghz j kj cal kcal pa kpa bar degree degrees celsius fahrenheit"
    .split()
)
#: Words that begin questions and sentences and are no names, wherever they stand.
NO_NAMES = frozenset(
    "a an and are at by can did do does each every find for from given has have how if in is it let of on one or that the"
    " there these this to was were what when where which who why will with".split()
)
#: A number, which ends where letters begin, so that ``12kg`` and ``3x`` are two tokens; a word, which may hold digits
#: behind its first letter; the end of a sentence; a percent sign.
_TOKEN = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*(?:(?:st|nd|rd|th)(?![^\W_]))?|[^\W0-9_][^\W_]*(?:[.,:/][0-9]+)*|[.!?\n]|%")
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"


_WORD, _END, _NUM, _CAPITAL, _PERCENT, _UNIT, _CAPITALS = range(7)
_PLACEHOLDERS = (NUM, UNIT, NAME)


def _kind(token: str, low: str) -> int:
    if token in ".!?\n":
        return _END
    if token == "%":
        return _PERCENT
    if "0" <= token[0] <= "9":
        return _NUM
    if low in UNITS:
        return _UNIT
    if low in NO_NAMES:
        return _WORD
    if len(token) > 1 and token.isupper():
        return _CAPITALS
    return _CAPITAL if token[0].isupper() and token[1:2].islower() else _WORD


def _hash(token: str) -> int:
    """Alike for two tokens now and then, which the join by the windows' words tells apart."""
    return zlib.crc32(token.encode()) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF


class _Tokens(dict):
    """Numbers of tokens, given at first sight, with the kind, lower case and its hash of each."""

    KEPT = 400_000

    def __init__(self):
        super().__init__()
        self.low: list[str] = []
        self.kind, self.hash = array("b"), array("Q")

    def __missing__(self, token: str) -> int:
        self[token] = number = len(self.low)
        low = token.lower()
        self.low.append(low)
        self.kind.append(_kind(token, low))
        self.hash.append(_hash(low))
        return number


def _taken(values: array, kind: type, at: np.ndarray) -> np.ndarray:
    """A copy, since an array that numpy looks at cannot grow."""
    return np.frombuffer(values, kind)[at] if len(at) else np.empty(0, kind)


def _behind(held: np.ndarray) -> np.ndarray:
    out = np.zeros(len(held), bool)
    out[1:] = held[:-1]
    return out


class Canonical:
    """Templates of texts, and hashes of their windows."""

    def __init__(self):
        self.tokens = _Tokens()
        self.placeholders = np.array([_hash(p) for p in _PLACEHOLDERS], np.uint64)

    def __call__(self, text: str) -> Template:
        """A number starts with digits; a unit is a word of ``UNITS`` (or %) right behind a number; a name is a word of
        capitals alone, two or more, or one with a capital first and a small letter after it that does not begin a
        sentence; words of ``NO_NAMES`` are none."""
        if len(self.tokens.low) > _Tokens.KEPT:
            self.tokens = _Tokens()
        found = _TOKEN.findall(text)
        tokens = self.tokens
        number = np.fromiter(map(tokens.__getitem__, found), np.int64, len(found))
        kind = _taken(tokens.kind, np.int8, number)
        word = kind != _END
        sentence = np.cumsum(~word, dtype=np.int32)[word]
        number, kind = number[word], kind[word]
        behind_number = _behind(kind == _NUM)
        if (stray := (kind == _PERCENT) & ~behind_number).any():
            number, kind, sentence = number[~stray], kind[~stray], sentence[~stray]
            behind_number = _behind(kind == _NUM)
        inside = np.zeros(len(kind), bool)
        np.equal(sentence[1:], sentence[:-1], out=inside[1:])
        slot = np.full(len(kind), -1, np.int8)
        slot[kind == _NUM] = 0
        slot[((kind == _UNIT) & behind_number) | (kind == _PERCENT)] = 1
        slot[((kind == _CAPITAL) & inside) | (kind == _CAPITALS)] = 2
        words = _taken(tokens.hash, np.uint64, number)
        return Template(number, slot, words, np.where(slot >= 0, self.placeholders[slot], words), tokens.low, bool((kind[:1] == _CAPITAL).any()))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _window_hashes(hashes: np.ndarray, size: int, start: int) -> np.ndarray:
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, start + size, np.uint64)
    for i in range(size):
        out = out * _STEP + hashes[i : i + n]
        out ^= out >> np.uint64(29)
    return out


class Template:
    def __init__(self, number, slot, words, hashes, low, capital):
        self.number, self.slot, self.plain, self.hashes, self.low = number, slot, words, hashes, low
        self.capital = capital  # whether the first word could be a name

    def __len__(self) -> int:
        return len(self.number)

    def words(self, at: int, size: int) -> list[str]:
        return [self.low[i] for i in self.number[at : at + size]]

    def text(self, at: int, size: int) -> str:
        slots = self.slot[at : at + size]
        return " ".join(w if s < 0 else _PLACEHOLDERS[s] for w, s in zip(self.words(at, size), slots, strict=True))

    def literal(self, at: int, size: int) -> str:
        """The words of a window; no template begins like it."""
        return "= " + " ".join(self.words(at, size))

    def literals(self, size: int) -> np.ndarray:
        """Hash of the words of each window of ``size`` tokens."""
        return _window_hashes(self.plain, size, 0)

    def templates(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the windows that can be asked again with other values: they have a slot, but at least
        half of them, and ``PLAIN_WORDS``, are plain words, or a row of numbers would be a question."""
        if size > len(self) or not (self.slot >= 0).any():
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        slots = np.cumsum(np.r_[0, self.slot >= 0])
        slots = slots[size:] - slots[:-size]
        places = np.flatnonzero((slots > 0) & (2 * slots <= size) & (size - slots >= PLAIN_WORDS))
        return places, _window_hashes(self.hashes, size, 1 << 32)[places]

    def quoted(self, placeholders: np.ndarray) -> Template | None:
        """The same with a name as first word: an item's first word begins a sentence, its quotation may not."""
        if not self.capital or self.slot[0] >= 0:
            return None
        slot, hashes = self.slot.copy(), self.hashes.copy()
        slot[0], hashes[0] = 2, placeholders[2]
        return Template(self.number, slot, self.plain, hashes, self.low, False)


def _emit(schema, rows):
    arrays = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _item_windows(canonical: Canonical, text: str, window: int):
    """(place, string, words, windows of the item, hash) of an item's windows: those of ``window`` words, or the whole
    of a shorter item."""
    template = canonical(text)
    size = min(window, len(template))
    if not size:
        return
    n = len(template) - size + 1
    for at, h in enumerate(template.literals(size).tolist()):
        yield at, template.literal(at, size), template.words(at, size), n, h
    for at, h in zip(*template.templates(size), strict=True):
        yield int(at), template.text(at, size), template.words(at, size), n, int(h)
    if (quoted := template.quoted(canonical.placeholders)) is not None:
        for at, h in zip(*quoted.templates(size), strict=True):
            if at == 0:
                yield 0, quoted.text(0, size), quoted.words(0, size), n, int(h)


def _probe(hashes: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The i-th place of each hash in a filter of ``bits`` (a power of two)."""
    return ((hashes + np.uint64(i) * ((hashes >> np.uint64(32)) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def items_of(items: DataFrame, window: int) -> DataFrame:
    """(item_key, item_at, template, item_words, item_windows, hash): a row per window of ``items`` (item_key, text)."""
    out = pa.schema(
        [
            ("item_key", pa.string()),
            ("item_at", pa.int64()),
            ("template", pa.string()),
            ("item_words", pa.list_(pa.string())),
            ("item_windows", pa.int64()),
            ("hash", pa.int64()),
        ]
    )

    def run(batches):
        canonical = Canonical()
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                for at, string, words, n, h in _item_windows(canonical, t.as_py() or "", window):
                    rows.append((k.as_py(), at, string, words, n, h - (1 << 64) if h >> 63 else h))
                if len(rows) >= 20_000:
                    yield _emit(out, rows)
                    rows = []
            yield _emit(out, rows)

    return items.select("item_key", "text").mapInArrow(
        run, "item_key string, item_at long, template string, item_words array<string>, item_windows long, hash long"
    )


def window_filter(asked: DataFrame) -> tuple[np.ndarray, list[int]]:
    """(filter of the item windows' hashes as bytes, sizes of windows in use): words of 64 bits, OR-ed by Spark.

    It has ``WINDOW_BITS`` bits for each distinct window, within bounds that do not depend on the data.
    """
    stated = asked.select("hash", F.size("item_words").alias("size")).distinct()
    counts = {r["size"]: r["count"] for r in stated.groupBy("size").count().collect()}  # at most ``window`` sizes
    bits = LEAST_BITS
    while bits < min(MOST_BITS, WINDOW_BITS * sum(counts.values())):
        bits *= 2

    def run(batches):
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            i = np.unique(np.concatenate([_probe(hashes, i, bits) for i in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(i >> 6), pa.array(np.int64(1) << (i & 63))], names=["word", "bits"])

    words = stated.select("hash").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(bits >> 6, np.int64)
    got = words.toPandas()  # at most MOST_BITS / 64 rows
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint8), sorted(counts)


def windows_of(texts: DataFrame, sizes: list[int], filter_) -> DataFrame:
    """(key, at, template, words) of the windows of ``texts`` (key, t) that the broadcast filter lets through."""
    out = pa.schema([("key", pa.string()), ("at", pa.int64()), ("template", pa.string()), ("words", pa.list_(pa.string()))])

    def run(batches):
        canonical, held = Canonical(), filter_.value
        bits = 8 * len(held)

        def passed(hashes):
            alive = np.arange(len(hashes))
            for i in range(PROBES):
                at = _probe(hashes[alive], i, bits)
                alive = alive[held[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
            return alive

        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                template = canonical(t.as_py() or "")
                for size in sizes:
                    for at in passed(template.literals(size)).tolist():
                        rows.append((k.as_py(), at, template.literal(at, size), template.words(at, size)))
                    places, hashes = template.templates(size)
                    for at in places[passed(hashes)].tolist():
                        rows.append((k.as_py(), at, template.text(at, size), template.words(at, size)))
                if len(rows) >= 20_000:
                    yield _emit(out, rows)
                    rows = []
            yield _emit(out, rows)

    return texts.mapInArrow(run, "key string, at long, template string, words array<string>")


def _asked(benchmark: DataFrame, item_text_col: str, window: int) -> DataFrame:
    """Windows of the distinct texts of items; ``item_key`` is the md5 of the text."""
    text = F.col(item_text_col).cast("string")
    items = benchmark.where(text.isNotNull()).select(text.alias("text")).distinct()
    return checkpointed(items_of(items.select(F.md5(F.col("text").cast("binary")).alias("item_key"), "text"), window))


def _held(docs: DataFrame, asked: DataFrame, text_col: str) -> DataFrame:
    """(key, at, template, words): windows of the distinct places of texts that may be items'."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("t"))
    texts = texts.select(F.md5(F.col("t").cast("binary")).alias("key"), "t")
    bits, sizes = window_filter(asked)
    return checkpointed(windows_of(texts, sizes, docs.sparkSession.sparkContext.broadcast(bits)).distinct())


def _lined(held: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, item_key, n_windows, item_windows, changed_slots, literal) of the alignments that are leaks."""
    pairs = held.join(asked.drop("hash"), "template").withColumn("shift", F.col("at") - F.col("item_at"))
    slots = F.transform(
        F.filter(
            F.arrays_zip(F.split("template", " ").alias("t"), F.col("item_words").alias("i"), F.col("words").alias("d")),
            lambda x: x["t"].isin(NUM, UNIT, NAME),
        ),
        lambda x: F.struct(x["t"].alias("t"), x["i"].alias("i"), x["d"].alias("d")),
    )
    # One alignment has no more windows than its item, so these sets are small.
    lined = pairs.groupBy("key", "item_key", "shift").agg(
        F.countDistinct("item_at").alias("n_windows"),
        F.max("item_windows").alias("item_windows"),
        F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"),
        F.max(F.size(F.filter(slots, lambda x: x["i"] != x["d"])) == 0).alias("literal"),
    )
    one_way = F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["t"], x["i"])))) == F.size("slots")
    other_way = F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["t"], x["d"])))) == F.size("slots")
    changed = F.size(F.filter("slots", lambda x: x["i"] != x["d"]))
    return lined.where((one_way & other_way) | F.col("literal")).withColumn("changed_slots", changed.cast("long"))


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, item_key, n_windows, item_windows, changed_slots): texts with items, both by their md5.

    One row per text and item that share windows along one alignment, if one of the windows is the same word for
    word or all slots of those windows are consistent.  Items shorter than ``window`` words are searched whole,
    however short; those without words match nothing.  Other values in slots are looked for in windows of which at
    least half, and ``PLAIN_WORDS``, are no slots.  Null texts match nothing.  Repeated texts share a key.  Very long
    texts are searched whole.
    """
    asked = _asked(benchmark, item_text_col, window)
    return (
        _lined(_held(docs, asked, text_col), asked)
        .groupBy("key", "item_key")
        .agg(
            F.max("n_windows").alias("n_windows"),
            F.max("item_windows").alias("item_windows"),
            F.min("changed_slots").alias("changed_slots"),
        )
    )


def leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(key): the texts of ``matches``, without telling the items.

    A window word for word is a leak by itself, so a text needs one and meets each item text once; a word that is an
    item, in however many texts and places, is a semi-join.  Only windows with slots are lined up with their items.
    """
    asked = _asked(benchmark, item_text_col, window)
    held = _held(docs, asked, text_col)
    literal = F.col("template").startswith("= ")
    plain = held.where(literal).select("key", "template").distinct()
    plain = plain.join(asked.where(literal).select("template").distinct(), "template", "left_semi").select("key").distinct()
    rest = held.where(~literal).join(plain, "key", "left_anti")
    return plain.unionByName(_lined(rest, asked.where(~literal)).select("key").distinct())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, changed_slots): rows of ``docs`` that hold benchmark items.

    Repeated rows, and items of one text, each return theirs; null ids are kept; texts that are null or hold no item
    return none.
    """
    found = matches(docs, benchmark, text_col=text_col, item_text_col=item_text_col, window=window)
    md5 = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), md5(text_col).alias("key"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), md5(item_text_col).alias("item_key"))
    return rows.join(found, "key").join(items, "item_key").select("doc_id", "item_id", "n_windows", "item_windows", "changed_slots")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; null texts stay."""
    found = leaking(docs, benchmark, text_col=text_col, window=window).select(F.col("key").alias("__leak"))
    key = F.md5(F.col(text_col).cast("string").cast("binary"))
    return docs.join(found, key == F.col("__leak"), "left_anti")

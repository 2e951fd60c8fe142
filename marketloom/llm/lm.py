"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The n-gram counts of the training texts are quantised to levels, level = 1 + floor(log2 count), and an n-gram
of level q is put into one Bloom filter q times, once for each level up to its own.  A count is read back by
asking for level 1, 2, ... until one is missing.  The filter is blocked (all bits of an entry lie in one
512-bit block), so it is cut into segments and grows with the corpus without ever being in one place: batches
of texts send their distinct n-grams to the segments, a task fills each segment and probes it for all
batches, and the levels go back to the batch's texts, which are scored there.  Batches and segments both grow with
the root of the corpus, so the rows between them grow in proportion to it.

Probabilities are interpolated: p(w | v) = LAMBDA c(v w) / c(v) + (1 - LAMBDA) p(w), with the unigram smoothed as in
the base score; behind a token that was never seen, p(w | v) = p(w).

Beside it, an exact unigram base score.  Counts of the most frequent tokens are broadcast (a bounded table);
occurrences of all other tokens meet their counts in a join, pre-aggregated per document.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, distinct, utf8

#: The end of a text.  It holds a space, so no word is like it.
END = b"</s> "
LAMBDA = 0.7
#: Pseudo-count of the unigrams.
PRIOR = 0.1
#: Tokens whose counts are broadcast, and bytes above which a token is known by its digest there.
FREQUENT, LONG = 200_000, 64
#: Bits of the filter for each training token.  The filter grows with them; no process holds more than a segment.
BITS_PER_TOKEN = 32
PROBES = 3
BLOCK = 512
#: Training tokens to a segment of the filter, about; segments are a power of two.
SEGMENT_TOKENS = 1 << 19
LEAST_SEGMENTS = 1 << 4
#: Bytes of one batch of texts, about; a task sums its n-grams at a time.
SUMMED = 10_000_000
#: Training tokens up to which segments and batches are that large; beyond, both grow by the root of the excess, so at
#: 10^13 tokens a segment has 16 million (64 MB packed) and a batch 340 MB of texts.
ROOTED = 1 << 33
#: Bits of a key, and blocks of a segment that are filled at a time, a byte a bit.
KEY_BITS, FILLED = 48, 1 << 15
_LEVELS = 48
_GOLD, _SEED_2, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def tokens(data: bytes) -> list[bytes]:
    """Words of the text in ASCII lower case, then one end."""
    return [*data.lower().split(), END]


def _short(token: bytes) -> bytes:
    """The token, or a space, which no word holds, and the md5 of a long one."""
    return b" " + hashlib.md5(token).digest() if len(token) > LONG else token


class Vocabulary:
    """Numbers for tokens, with arrays of what is known of each; it starts anew when it is full."""

    KEPT = 200_000

    def __init__(self, describe):
        """``describe`` turns a list of new tokens into a tuple of arrays, one item for each."""
        self.describe = describe
        self.clear()

    def clear(self):
        self.number: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.columns: list[np.ndarray] = []

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The number of each word; columns and names hold until the next call."""
        if len(self.names) > self.KEPT:
            self.clear()
        new = list(set(words).difference(self.number))
        if new:
            at = len(self.names)
            self.number.update(zip(new, range(at, at + len(new)), strict=True))
            self.names += new
            for i, values in enumerate(self.describe(new)):
                if i == len(self.columns):
                    self.columns.append(np.empty(0, values.dtype))
                if len(self.columns[i]) < len(self.names):
                    grown = np.empty(2 * len(self.names), values.dtype)
                    grown[:at] = self.columns[i][:at]
                    self.columns[i] = grown
                self.columns[i][at : len(self.names)] = values
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _scattered(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _GOLD
    return h ^ (h >> np.uint64(29))


def mixed(h: np.ndarray) -> np.ndarray:
    """Keys of n-grams: 48 bits.  Two of a billion keys are equal about as rarely as one in half a million."""
    return _scattered(h) >> np.uint64(16)


def bigrams(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; those at ``starts`` follow the start."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts] = _START
    return mixed(before * _SEED_2 + h)


def joined(batch_column):
    """Chunks of texts as (all tokens, where each text starts)."""
    words: list[bytes] = []
    starts: list[int] = []
    for t in batch_column:
        starts.append(len(words))
        words += tokens(t.as_py() or b"")
        if len(words) > 250_000:
            yield words, np.array(starts)
            words, starts = [], []
    if starts:
        yield words, np.array(starts)


def inside(h: np.ndarray, level: int) -> list[np.ndarray]:
    """Bits of entries at one level inside their blocks."""
    one = _scattered(h + np.uint64(level * int(_SEED_2) & 0xFFFFFFFFFFFFFFFF))
    step = (one >> np.uint64(40)) | np.uint64(1)
    return [(one + np.uint64(i) * step) & np.uint64(BLOCK - 1) for i in range(PROBES)]


def levels(h: np.ndarray, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Level of each n-gram, whose block is given, by repeated membership probes; 0 where level 1 is missing."""
    found, alive = np.zeros(len(h), np.int64), np.arange(len(h))
    for level in range(1, _LEVELS):
        held = np.ones(len(alive), bool)
        for i in inside(h[alive], level):
            at = block[alive] * np.uint64(BLOCK) + i
            held &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        alive = alive[held]
        if not len(alive):
            break
        found[alive] = level
    return found


def counts_of(level: np.ndarray) -> np.ndarray:
    """Geometric middle of the counts that a level stands for, since scores add up logarithms; 0 for level 0."""
    low = np.exp2(np.maximum(level, 1) - 1)
    return np.where(level > 0, np.sqrt(low * (2 * low - 1)), 0.0)


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, c): exact counts; each task sums its tokens before they are dealt."""

    def summed(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"]
        )

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(tokens(t.as_py() or b""))
                if len(seen) > 300_000:
                    yield summed(seen)
                    seen = Counter()
        yield summed(seen)

    return docs.select(utf8(text_col).alias("t")).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def growth(train_tokens: int) -> float:
    """How many times larger segments and batches are than at their least."""
    return max(1.0, (train_tokens / ROOTED) ** 0.5)


def segments_of(train_tokens: int) -> int:
    wanted = max(1, int(train_tokens / (SEGMENT_TOKENS * growth(train_tokens))))
    return max(LEAST_SEGMENTS, 1 << (wanted - 1).bit_length())


def filter_bits(train_tokens: int) -> int:
    """Size of the filter in bits: by the training tokens, without a bound; a multiple of all segments."""
    unit = segments_of(train_tokens) * BLOCK
    return max(1, -(-train_tokens * BITS_PER_TOKEN // unit)) * unit


def pack(keys: np.ndarray, counts: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Ascending keys below 2^bits: the low bytes of each as they are, and the steps of the rest with the counts."""
    low = min(bits, max(0, bits - max(1, len(keys)).bit_length()))
    size = -(-low // 8)
    shift = np.uint64(8 * size)
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()
    step = np.diff(keys >> shift, prepend=np.uint64(0))
    return bytes([size]) + raw, _varint(np.stack([step, counts.astype(np.uint64)]).ravel())


def _varint(values: np.ndarray) -> bytes:
    """Bytes of 255 stand for 255 more of the value that follows."""
    more = (values // np.uint64(255)).astype(np.int64)
    out = np.full(len(values) + int(more.sum()), 255, np.uint8)
    out[np.arange(len(values)) + np.cumsum(more)] = values % np.uint64(255)
    return out.tobytes()


def unpack(low: bytes, rest: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, data = low[0], np.frombuffer(rest, np.uint8)
    ends = np.flatnonzero(data != 255)
    values = data[ends].astype(np.uint64) + np.uint64(255) * np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(255)
    n = len(values) // 2
    keys = np.zeros((n, 8), np.uint8)
    keys[:, :size] = np.frombuffer(low, np.uint8, offset=1).reshape(n, size) if size else 0
    return (np.cumsum(values[:n]) << np.uint64(8 * size)) | keys.view("<u8").ravel(), values[n:].astype(np.int64)


@dataclass
class Segments:
    """Shape of the filter for ``train_tokens``: equal segments by the leading bits of the keys."""

    train_tokens: int

    def __post_init__(self):
        self.count = segments_of(self.train_tokens)
        self.inner = KEY_BITS - (self.count.bit_length() - 1)  # bits of a key inside its segment
        self.own = filter_bits(self.train_tokens) // BLOCK // self.count  # blocks of a segment

    def block(self, keys: np.ndarray) -> np.ndarray:
        """The block of each key inside its segment, by the key's bits there; ascending as the keys of a segment are."""
        lead = max(0, self.inner - 32)  # bits enough for any segment, and few enough for the product
        inner = (keys & np.uint64((1 << self.inner) - 1)) >> np.uint64(lead)
        return inner * np.uint64(self.own) >> np.uint64(self.inner - lead)

    def cut(self, keys: np.ndarray, counts: np.ndarray):
        """(segment, packed keys and counts) of each segment that has some of the ascending keys."""
        own = keys >> np.uint64(self.inner)
        cuts = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(keys)] if len(keys) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(own[a]), *pack(keys[a:b] - (own[a] << np.uint64(self.inner)), counts[a:b], self.inner)

    def filled(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bytes of the segment of the ascending distinct keys; those with counts of 0 are left out."""
        top = np.where(counts > 0, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, 0)
        block, out = self.block(keys), np.zeros(self.own * BLOCK // 8, np.uint8)
        for first in range(0, self.own, FILLED):
            size = min(FILLED, self.own - first)
            part = slice(*np.searchsorted(block, [first, first + size]))
            bits = np.zeros(size * BLOCK, bool)
            for level in range(1, int(top[part].max(initial=0)) + 1):
                some = top[part] >= level
                start = (block[part][some] - np.uint64(first)) * np.uint64(BLOCK)
                for i in inside(keys[part][some], level):
                    bits[(start + i).astype(np.int64)] = True
            out[first * BLOCK // 8 :][: size * BLOCK // 8] = np.packbits(bits, bitorder="little")
        return out

    def answered(self, segment: int, parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(the segment's bytes, levels of each part's keys)."""
        held = [unpack(*part) for part in parts]
        keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        keys = keys + (np.uint64(segment) << np.uint64(self.inner))
        bits = self.filled(keys, np.bincount(back, np.concatenate([n for _, n in held])))
        found = levels(keys, self.block(keys), bits).astype(np.uint8)[back]
        return bits, np.split(found, np.cumsum([len(k) for k, _ in held])[:-1])


_SENT = "segment int, batch long, low binary, rest binary"
_PROBED = "batch long, segment int, data binary"


def _cut(batches, most: int):
    """(name, slices) of batches of a task's texts, each of about ``most`` bytes.

    The name is a digest of the task, the place in it and the texts, so what is read twice meets its like or nothing.
    """
    from xxhash import xxh64

    seed, held, size = None, [], 0

    def named():
        digest = xxh64(seed=seed)
        for part in held:
            for t in part.column(2):
                text = t.as_py() or b""
                digest.update(b"%d " % len(text))
                digest.update(text)
        return digest.intdigest() - (1 << 63), held

    for batch in batches:
        if not batch.num_rows:
            continue
        seed = batch.column(3)[0].as_py() << 32 if seed is None else seed
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + len(END))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(batch.num_rows, int(np.searchsorted(ends, before + most - size, side="right")) + 1)
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if size > most:
                yield named()
                seed, held, size = seed + 1, [], 0
    if held:
        yield named()


def _sent(shape: Segments, most: int):
    """Each batch of texts gives each segment its distinct keys in order, with their counts in the training texts:
    0 for keys of other texts alone."""

    def run(batches):
        vocabulary = Vocabulary(lambda new: (hashes(new),))
        for name, parts in _cut(batches, most):
            used, other = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for part in parts:
                at = 0
                for words, starts in joined(part.column(2)):
                    known = part.column(1).slice(at, len(starts)).to_numpy(zero_copy_only=False)
                    known = np.repeat(known, np.diff(np.r_[starts, len(words)]))
                    at += len(starts)
                    numbers = vocabulary(words)
                    h = vocabulary.columns[0][numbers]
                    for keys in (mixed(h), bigrams(h, starts)):
                        used.append(keys[known])
                        other.append(keys[~known])
            keys, n = np.unique(np.concatenate(used), return_counts=True)
            every = distinct(np.concatenate([keys, *other]))
            counts = np.zeros(len(every), np.int64)
            counts[np.searchsorted(every, keys)] = n
            rows = list(shape.cut(every, counts))
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([name] * len(rows), pa.int64())]
            columns += [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "batch", "low", "rest"])

    return run


def _packed_texts(most: int):
    """The texts of the same batches, packed, with no segment."""

    def run(batches):
        for name, parts in _cut(batches, most):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in parts:
                    out.write_batch(part)
            columns = [pa.array([name], pa.int64()), pa.nulls(1, pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["batch", "segment", "data"])

    return run


def _probed(shape: Segments):
    """Fills each segment and, in the order of its keys, gives each batch their levels; rows come sorted by segment."""

    def run(batches):
        def done():
            data = [x.tobytes() for x in shape.answered(segment, parts)[1]]
            columns = [pa.array(names, pa.int64()), pa.array([segment] * len(data), pa.int32()), pa.array(data, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["batch", "segment", "data"])

        segment, names, parts = None, [], []
        for batch in batches:
            for s, name, low, rest in zip(*(batch.column(i) for i in range(4)), strict=True):
                if s.as_py() != segment:
                    if parts:
                        yield done()
                    segment, names, parts = s.as_py(), [], []
                names.append(name.as_py())
                parts.append((low.as_py(), rest.as_py()))
        if parts:
            yield done()

    return run


def score_texts(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    summed: int | None = None,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    The model learns from rows where ``usable`` holds.  A null text counts as empty: its one token is the
    end.  Without training rows N and V are 0 and every token has probability PRIOR / PRIOR = 1 in the base.
    Ids may be null or repeated; extra columns are ignored.  A task holds some tens of bytes for each byte of
    a batch of texts and for each token of a segment; both grow with the corpus (``growth``) unless ``summed``, the
    bytes of a batch, is given.  ``docs`` is read more than once; if its tasks do not
    get the same rows each time, the run fails.
    """
    spark = docs.sparkSession
    train = docs.where(usable)
    counted = checkpointed(token_counts(train, text_col))
    totals = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(totals["n"]), int(totals["v"])
    below = log10(n + PRIOR * (v + 1))
    # At most ``frequent`` tokens; long ones go by their digest, so a frequent one is no heavier and no key of a join.
    short = F.when(F.length("token") > LONG, F.concat(F.lit(b" "), F.unhex(F.md5("token")))).otherwise(F.col("token"))
    top = counted.orderBy(F.desc("c"), "token").limit(frequent).select(short, "c").toArrow()
    known = zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True)
    shared = spark.sparkContext.broadcast({t: log10(c + PRIOR) - below for t, c in known})
    shape = Segments(n)
    summed = summed or int(SUMMED * growth(n))
    end = mixed(hashes([END]))

    def run(batches):
        known = shared.value
        missing = float("nan")

        def describe(new):
            h = hashes(new)
            return h, np.fromiter((known.get(_short(w), missing) for w in new), np.float64, len(new))

        vocabulary = Vocabulary(describe)
        kind = pa.list_(pa.struct([("token", pa.binary()), ("k", pa.int64())]))

        def chunks(texts):
            """(starts, keys of unigrams, keys of bigrams, columns without the score) of chunks of texts."""
            at = 0
            for words, starts in joined(texts.column(2)):
                numbers = vocabulary(words)
                h, base = (c[numbers] for c in vocabulary.columns)
                rare = np.isnan(base)
                sizes = np.diff(np.r_[starts, len(words)])
                text = np.repeat(np.arange(len(starts)), sizes)[rare]
                size = np.int64(len(vocabulary.names))
                pairs, k = np.unique(text * size + numbers[rare], return_counts=True)
                names, owner = vocabulary.names, pairs // size
                tokens_ = pa.array([names[i] for i in pairs % size], pa.binary())
                flat = pa.StructArray.from_arrays([tokens_, pa.array(k.astype(np.int64))], fields=list(kind.value_type))
                offsets = np.searchsorted(owner, np.arange(len(starts) + 1)).astype(np.int32)
                columns = [
                    texts.column(0).slice(at, len(starts)),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(np.add.reduceat((~rare).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.where(rare, 0.0, base), starts)),
                    pa.ListArray.from_arrays(pa.array(offsets), flat),
                ]
                at += len(starts)
                yield starts, mixed(h), bigrams(h, starts), columns

        def scored(texts, answers):
            """Batches of rows of one batch of texts; ``answers`` are its levels by segment."""
            held = [x for data in texts for batch in pa.ipc.open_stream(data) for x in chunks(batch)]
            keys, back = np.unique(np.concatenate([np.empty(0, np.uint64), *(k for x in held for k in x[1:3])]), return_inverse=True)
            level = np.frombuffer(b"".join(answers[s] for s in sorted(answers)), np.uint8)
            if len(level) != len(keys):
                raise RuntimeError("texts read twice differ: checkpoint the documents first")
            count = counts_of(level.astype(np.int64))
            # Texts begin as often as they end.
            begins = max(1.0, float(count[np.searchsorted(keys, end)[0]]))
            at = 0
            for starts, uni_keys, _, columns in held:
                size = len(uni_keys)
                uni, both = count[back[at : at + size]], count[back[at + size : at + 2 * size]]
                at += 2 * size
                context = np.empty_like(uni)
                context[1:] = uni[:-1]
                context[starts] = begins
                alone = np.minimum(1.0, (uni + PRIOR) / max(n + PRIOR * (v + 1), PRIOR))
                behind = LAMBDA * np.minimum(1.0, both / np.maximum(context, 1.0)) + (1 - LAMBDA) * alone
                p = np.where(context > 0, behind, alone)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.add.reduceat(np.log10(p), starts))],
                    names=["doc_id", "n_tokens", "hits", "base", "rare", "score"],
                )

        number, texts, answers = None, [], {}
        for batch in batches:
            for own, segment, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                if own.as_py() != number:
                    if number is not None:
                        yield from scored(texts, answers)
                    number, texts, answers = own.as_py(), [], {}
                if segment.is_valid:
                    answers[segment.as_py()] = data.as_py()
                else:
                    texts.append(data.as_py())
        if number is not None:
            yield from scored(texts, answers)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(usable, F.lit(False)).alias("u"),
        utf8(text_col).alias("t"),
        F.spark_partition_id().alias("p"),  # counted from 0 in either reading, as a task's own number is not
    )
    sent = rows.mapInArrow(_sent(shape, summed), _SENT).repartition("segment").sortWithinPartitions("segment")
    probed = sent.mapInArrow(_probed(shape), _PROBED)
    # The texts are read once more here, since to carry them through the segments would shuffle them twice.
    met = probed.unionByName(rows.mapInArrow(_packed_texts(summed), _PROBED)).repartition("batch").sortWithinPartitions("batch")
    scored = met.mapInArrow(
        run, "doc_id long, n_tokens long, hits long, base double, rare array<struct<token:binary,k:long>>, score double"
    )
    # From here on a row is known by its number, fixed by writing it.
    scored = checkpointed(scored.withColumn("row", F.monotonically_increasing_id()))
    asked = scored.select("row", F.explode("rare").alias("x")).select("row", "x.token", "x.k")
    c = F.coalesce("c", F.lit(0))
    rest = (
        asked.join(counted, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("rest_hits"),
            F.sum(F.col("k") * (F.log10(c + F.lit(PRIOR)) - F.lit(below))).alias("rest_base"),
        )
    )
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("hits") + F.coalesce("rest_hits", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"),
        "score",
    )

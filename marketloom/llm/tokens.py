"""Token counts by heap-and-linked-list byte-pair merging; no token ids are made.

The vocabulary is a sentence-piece BPE file.  Its pieces hold the space mark only in front, or alone in
runs, so no merge crosses from a word into the mark behind it.  A text is therefore cut into units, a run of
marks and the word after it, and a unit's count is kept for its next occurrence.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
#: Units whose counts a Python worker keeps; beyond it the memory starts anew.
KEPT = 400_000
#: Largest vocabulary file that is broadcast.
MOST_BYTES = 64 << 20


def read_ranks(path: str) -> tuple[dict[str, int], bool]:
    """(rank of each mergeable piece, lowest merges first; whether unknown characters fall back to bytes)."""
    from pathlib import Path

    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    data = Path(path).read_bytes()
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; at most {MOST_BYTES} are broadcast")
    model = model_pb2.ModelProto()
    model.ParseFromString(data)
    norm = model.normalizer_spec
    plain = norm.name == "identity" and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    if model.trainer_spec.model_type != model_pb2.TrainerSpec.BPE or not plain:
        raise ValueError(f"{path} is not a BPE model with identity normalisation, dummy prefix and kept spaces")
    if any(p.type in (4, 5) for p in model.pieces):
        raise ValueError(f"{path} has user-defined or unused pieces")
    pieces = sorted((p for p in model.pieces if p.type == 1), key=lambda p: -p.score)
    if any(MARK in p.piece.lstrip(MARK) for p in pieces):
        raise ValueError(f"{path} has pieces with a space mark after a character")
    return {p.piece: i for i, p in enumerate(pieces)}, model.trainer_spec.byte_fallback


def count_unit(unit: str, ranks: dict[str, int], bytes_for_unknown: bool = True) -> int:
    """Symbols at first, less the merges.  An unknown character stands for its UTF-8 bytes, or for one symbol."""
    symbols = list(unit)
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(unit[i : i + 2])) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, i, size = heappop(heap)
        j = after[i] if symbols[i] else -1
        if j < 0 or len(symbols[i]) + len(symbols[j]) != size:
            continue  # one of the two has been merged since
        symbols[i] += symbols[j]
        symbols[j] = ""
        after[i] = after[j]
        merges += 1
        if after[j] >= 0:
            before[after[j]] = i
            pair = symbols[i] + symbols[after[j]]
            if (r := ranks.get(pair)) is not None:
                heappush(heap, (r, i, len(pair)))
        if before[i] >= 0:
            pair = symbols[before[i]] + symbols[i]
            if (r := ranks.get(pair)) is not None:
                heappush(heap, (r, before[i], len(pair)))
    extra = 0
    if bytes_for_unknown:
        extra = sum(len(s.encode()) - 1 for s in symbols if s and len(s.encode()) > 1 and s not in ranks)
    return n - merges + extra


class Counter:
    def __init__(self, ranks: dict[str, int], bytes_for_unknown: bool):
        self.ranks, self.bytes_for_unknown = ranks, bytes_for_unknown
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        total, known = 0, self.known
        for unit in _UNIT.findall(MARK + text.replace(" ", MARK)):
            count = known.get(unit)
            if count is None:
                count = count_unit(unit, self.ranks, self.bytes_for_unknown)
                if len(unit) <= 64:
                    if len(known) >= KEPT:
                        known.clear()
                    known[unit] = count
            total += count
        return total


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens): one row per input row.

    Null counts as an empty text; both have 0 bytes and 0 tokens.  No begin, end or special tokens; their
    strings inside a text are plain text.  Ids may be null or repeated; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(model_path))  # at most MOST_BYTES

    def run(batches):
        count = Counter(*shared.value)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            numbers = [(len(t.encode()), count(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[0] for x in numbers], pa.int64()),
                    pa.array([x[1] for x in numbers], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")

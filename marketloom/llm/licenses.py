"""Licence scan: exact phrases, and short notices with a bounded number of errors.

A notice with at most k errors holds one of its k + 1 pieces unchanged.  The pieces of all notices are the
seeds of one Aho-Corasick automaton; around each seed that it finds, the ``regex`` library matches the whole
notice with at most k errors and gives the span.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

#: Phrases that count exactly, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Short notices of public licences, with SPDX-like labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa"),
    ("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd"),
    ("released into the public domain", "public-domain"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("all rights reserved", "reserved"),
)
#: Words that a notice with its errors has at most.
LONGEST = 40
#: Characters of a notice to each error allowed.
CHARS_PER_ERROR = 12
_BETWEEN = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case and characters beyond ASCII."""
    return data.translate(_BETWEEN).split()


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES, chars_per_error: int = CHARS_PER_ERROR):
        import ahocorasick
        import regex

        self.phrases = [(f" {p} ", label) for p, label in phrases]
        self.notices, seeds = [], {}
        for n, (notice, label) in enumerate(notices):
            k = len(notice) // chars_per_error
            cuts = [i * len(notice) // (k + 1) for i in range(k + 2)]
            fuzzy = regex.compile(rf"(?b)(?: {regex.escape(notice)} ){{e<={k}}}")
            self.notices.append((notice, label, k, fuzzy))
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(notice[a:b], []).append((n, a))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def base(self, line: str) -> list[tuple[int, str]]:
        """(first word, label) of every place of every phrase; places may overlap."""
        found = []
        for phrase, label in self.phrases:
            at, word, seen = line.find(phrase), 0, 0
            while at >= 0:
                word, seen = word + line.count(" ", seen, at), at
                found.append((word, label))
                at = line.find(phrase, at + 1)
        return found

    def fuzzy(self, line: str) -> list[tuple[str, int, int, int, int]]:
        """(label, first word, last word, errors, length of the notice) of every verified notice.

        A notice that lies inside the span of a longer one is part of it and is not told by itself.
        """
        tried, found, spaces = set(), {}, None
        for end, (size, places) in self.seeds.iter(line):
            for n, offset in places:
                notice, label, k, pattern = self.notices[n]
                start = end - size + 1 - offset  # where the notice begins if nothing is shifted
                if (n, start) in tried:
                    continue
                tried.add((n, start))
                low = max(0, start - 1 - k)
                m = pattern.search(line, low, min(len(line), start + len(notice) + 1 + k))
                if m:
                    inside = line[m.start() : m.end()]
                    if spaces is None:
                        spaces = [at for at, c in enumerate(line) if c == " "]
                    first = bisect_left(spaces, m.start() + len(inside) - len(inside.lstrip(" ")))
                    key = (label, first - 1)
                    errors = sum(m.fuzzy_counts)
                    if key not in found or errors < found[key][3]:
                        found[key] = (label, first - 1, first - 2 + len(inside.split()), errors, len(notice))
        begin: dict[int, list] = {}
        for y in found.values():
            begin.setdefault(y[1], []).append(y)
        # No notice has more words than this, so longer ones around a notice begin close before it.
        near = lambda x: (y for at in range(x[1] - LONGEST, x[1] + 1) for y in begin.get(at, ()))
        whole = [x for x in found.values() if not any(x[2] <= y[2] and x[4] < y[4] for y in near(x))]
        return sorted(whole, key=lambda x: (x[1], x[0]))

    def __call__(self, data: bytes) -> dict:
        words = words_of(data)
        # Words end at ASCII characters, so their bytes are whole code points, and a wrong letter is one error.
        line = f" {b' '.join(words).decode('utf-8', 'replace')} " if words else ""
        base, fuzzy = self.base(line), self.fuzzy(line)
        score = max([1.0] * bool(base) + [1 - errors / size for _, _, _, errors, size in fuzzy], default=0.0)
        return {
            "n_words": len(words),
            "base": [{"label": label, "word": at} for at, label in sorted(base)],
            "notices": [{"label": x[0], "first_word": x[1], "last_word": x[2], "errors": x[3]} for x in fuzzy],
            "score": score,
        }


@lru_cache(maxsize=4)
def _scanner(phrases, notices, chars_per_error) -> Scanner:
    return Scanner(phrases, notices, chars_per_error)


SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,word:long>>,"
    " notices array<struct<label:string,first_word:long,last_word:long,errors:long>>, score double"
)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: tuple = PHRASES,
    notices: tuple = NOTICES,
    chars_per_error: int = CHARS_PER_ERROR,
) -> DataFrame:
    """(doc_id, n_words, base, notices, score): one row per input row.

    ``base`` lists every place of every exact phrase by its first word, ``notices`` the verified notices
    with word spans (last word included) and errors.  ``score`` is 1 for an exact phrase, else 1 less the
    best notice's share of errors, else 0.  Null and empty texts have no words and score 0; ids may be null
    or repeated; extra columns are ignored.
    """
    kinds = [pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))]
    fields = [(n, pa.int64()) for n in ("first_word", "last_word", "errors")]
    kinds.append(pa.list_(pa.struct([("label", pa.string()), *fields])))

    def run(batches):
        scan = _scanner(phrases, notices, chars_per_error)
        for batch in batches:
            out = [scan(t.as_py() or b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x["n_words"] for x in out], pa.int64()),
                    pa.array([x["base"] for x in out], kinds[0]),
                    pa.array([x["notices"] for x in out], kinds[1]),
                    pa.array([x["score"] for x in out], pa.float64()),
                ],
                names=["doc_id", "n_words", "base", "notices", "score"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, SCHEMA)

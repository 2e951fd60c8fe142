"""Language identification by compression: the language whose dictionary codes a text shortest.

For every language a raw-content dictionary is joined from a bounded, fixed sample of labelled texts.  A text
is normalised, cut into pieces and every piece is compressed with each dictionary; the smallest total wins.
A language with little text has a shorter dictionary, so it meets the best of the others with that one's dictionary
cut to the same length.  Narrow margins are marked as not reliable.
"""

from __future__ import annotations

import re
from math import exp

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Texts that at most are sampled for one language, and bytes of them that make its dictionary.
SAMPLE_TEXTS = 300
SAMPLE_BYTES = 96 << 10
#: Of a longer text a piece of this many characters is sampled (it is predicted whole all the same).
SAMPLE_CHARS = 6000
#: Languages that are learned at most: each has a dictionary on the driver and in every worker, and costs a compression
#: of every text.  More are an error, as a column of anything else than languages would be.
MOST_LANGUAGES = 1_000
#: Characters that are compressed at a time.
PIECE = 8192
#: The winner must save at least this share of bytes against the second to be reliable.
MARGIN = 0.01
_NO_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def learn(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    sample_bytes: int = SAMPLE_BYTES,
) -> dict[str, bytes]:
    """Dictionary content per language, from rows where ``usable`` holds and the language is not null.

    Every language of those rows is learned, however rare and however long its texts; each costs one compression of
    every text.  More than ``MOST_LANGUAGES`` of them raise a ValueError.  For each language those texts count whose md5 of the id comes first, so that the sample is spread
    and fixed: at most ``sample_texts``, of a text over ``SAMPLE_CHARS`` characters a piece of that many whose
    place follows from the md5, and no more than about twice ``sample_bytes`` in all reach the driver.  Null and
    empty texts teach nothing, nor do those without a letter; repeated texts count once.
    """
    rows = docs.where(usable & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.md5(F.col(id_col).cast("string").cast("binary")).alias("h"),
        F.col(text_col).cast("string").alias("t"),
    )
    length = F.char_length("t")
    rows = rows.where(length > 0)
    named = rows.groupBy("lang").count()
    found = named.limit(MOST_LANGUAGES + 1).count()
    if found > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col!r}")
    if not found:
        return {}
    named = F.broadcast(named)  # a row a language
    # Of a frequent language only the hashes that can be among the first go on: about four times the sample,
    # however many rows there are.
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32
    near = rows.join(named, "lang").where(place * F.col("count") <= 4.0 * sample_texts)
    begin = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), length - SAMPLE_CHARS + 1)) + 1
    near = near.select("lang", "h", F.substring("t", begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
    order = Window.partitionBy("lang").orderBy("h", "t")
    first = near.withColumn("i", F.row_number().over(order)).where(F.col("i") <= sample_texts)
    before = F.coalesce(F.sum(F.octet_length("t")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sample = first.withColumn("before", before).where(F.col("before") < 2 * sample_bytes)
    parts: dict[str, list[str]] = {}
    for r in sorted(sample.select("lang", "i", "t").collect(), key=lambda r: (r["lang"], r["i"])):
        parts.setdefault(r["lang"], []).append(normalised(r["t"]))
    content = {lang: " ".join(filter(None, dict.fromkeys(texts))).encode() for lang, texts in parts.items()}
    return {lang: c[:sample_bytes] for lang, c in content.items() if c}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = 3):
        self.dictionaries, self.level, self.coders = dictionaries, level, {}
        #: Languages by the length that their dictionary is cut to, longest first.
        self.tiers: dict[int, list[str]] = {}
        longest = max(map(len, dictionaries.values()), default=0)
        for lang in sorted(dictionaries):
            size = longest
            while size > len(dictionaries[lang]):
                size //= 2
            self.tiers.setdefault(size, []).append(lang)
        self.tiers = dict(sorted(self.tiers.items(), reverse=True))

    def size(self, pieces: list[bytes], lang: str, length: int) -> int:
        """Bytes of the pieces with the first ``length`` bytes of a language's dictionary."""
        coder = self.coders.get((lang, length))
        if coder is None:
            import zstandard

            options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            data = zstandard.ZstdCompressionDict(self.dictionaries[lang][:length], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=self.level)
            coder = self.coders[lang, length] = zstandard.ZstdCompressor(level=self.level, dict_data=data, **options)
        return sum(len(coder.compress(p)) for p in pieces)

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, reliable).  The score falls from 1 to 1 / languages as the margin narrows."""
        plain = normalised(text or "")
        if not self.tiers or not any(map(str.isalpha, plain)):
            return UNKNOWN, 0.0, False
        pieces = [plain[i : i + PIECE].encode() for i in range(0, len(plain), PIECE)]
        cost: dict[str, int] = {}
        for length, langs in self.tiers.items():
            # Behind the leader, by as much as behind its dictionary of the same length.
            lead = min(cost.items(), key=lambda x: (x[1], x[0])) if cost else None
            shift = lead[1] - self.size(pieces, lead[0], length) if lead else 0
            cost |= {lang: self.size(pieces, lang, length) + shift for lang in langs}
        sizes = sorted((n, lang) for lang, n in cost.items())
        best, lang = sizes[0]
        score = 1 / sum(exp(max(-60.0, (best - s) / 2)) for s, _ in sizes)
        return lang, score, len(sizes) == 1 or sizes[1][0] - best >= max(1, MARGIN * max(1, best))


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", level: int = 3
) -> DataFrame:
    """(doc_id, lang_pred, score, reliable): one row per input row, from the text alone.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.  Ties go to
    the language first in code-point order.  Ids may be null or repeated; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most SAMPLE_BYTES a language

    def run(batches):
        classify = Classifier(shared.value, level)
        for batch in batches:
            out = [classify(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.float64()),
                    pa.array([x[2] for x in out], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "reliable"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, reliable boolean")

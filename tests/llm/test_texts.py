"""Tokens, licences, language, quality, decontamination and language-model scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from plain import brute_leaks
from pyspark.sql import functions as F

from marketloom.llm import decontam, langid, licenses, lm, quality, queries, tokens
from marketloom.llm.common import held_out, learned

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "  ", "a  b   c", "<s> hi </s> <unk> <0x0A>", "日本語 テスト\n\n\t x", "▁▁a ▁b", "é" * 50, "😀 hi", "   lead", "trail   ", "12345", "x" * 3000]


def test_token_counts_equal_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aeinst  .,\nT é▁0") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    got = {r["doc_id"]: r for r in tokens.count_tokens(docs([*texts, None]), MODEL).collect()}
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(t)), repr(t[:50])
        assert got[i]["n_bytes"] == len(t.encode())
    assert (got[len(texts)]["n_tokens"], got[len(texts)]["n_bytes"]) == (0, 0)
    assert tokens.count_tokens(docs([]), MODEL).count() == 0


def test_token_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    count = tokens.Counter(*tokens.read_ranks(MODEL))
    text = " ".join(f"word{i}" for i in range(50))
    assert count(text) == len(library.encode(text)) and len(count.known) <= 3


def test_licences_exact_and_fuzzy(spark, docs):
    texts = [
        "All rights reserved. all-rights  RESERVED",
        "cc by cc by",
        "Licensed under the Apache Licence, Version 2.0.",
        "released under teh MIT license",
        "nothing here",
        "",
        None,
        "allrights reserved",
        "x " * 30000 + "General Public License",
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(texts)).collect()}
    assert [(b["label"], b["word"]) for b in got[0]["base"]] == [("reserved", 0), ("reserved", 3)]
    assert [b["word"] for b in got[1]["base"]] == [0, 2]
    assert [(n["label"], n["first_word"], n["last_word"], n["errors"]) for n in got[2]["notices"]] == [("apache-2.0", 0, 7, 1)]
    assert [n["label"] for n in got[3]["notices"]] == ["mit"] and 0 < got[3]["score"] < 1
    assert all(not got[i]["base"] and not got[i]["notices"] and got[i]["score"] == 0 for i in (4, 5, 6))
    assert got[5]["n_words"] == got[6]["n_words"] == 0
    assert not got[7]["base"] and [n["label"] for n in got[7]["notices"]] == ["reserved"]
    assert got[8]["base"][0]["word"] == 30000
    assert licenses.scan_licenses(docs([])).count() == 0


def test_licence_query_counts_places(spark, sf):
    import re

    for r in queries.op2_licenses(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
        ]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    share = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.95


def test_language_edge_cases(spark, docs):
    train = docs([(i, f"the house and the garden number {i} are here") for i in range(20)]).unionByName(
        docs([(100 + i, f"das haus und der garten nummer {i} sind hier") for i in range(20)], lang="de")
    )
    known = langid.learn(train.unionByName(docs([(200, "null lang")], lang=None)), learned("doc_id", 5))
    assert set(known) == {"de", "en"}
    got = {r["doc_id"]: r for r in langid.identify(docs(["the garden is here", "der garten ist hier", None, "", "123 %% 456", "a"]), known).collect()}
    assert [got[i]["lang_pred"] for i in range(5)] == ["en", "de", "und", "und", "und"]
    assert got[5]["lang_pred"] in ("de", "en") and not got[5]["reliable"]
    assert langid.learn(docs([]), learned("doc_id", 5)) == {}
    assert {r["lang_pred"] for r in langid.identify(docs(["text"]), {}).collect()} == {"und"}


def plain_language(text, dictionaries):
    """The smallest total over the pieces, by compressors made for each call."""
    import zstandard

    plain = langid.normalised(text or "")
    if not any(map(str.isalpha, plain)):
        return "und"

    def size(content):
        coder = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        return sum(len(coder.compress(plain[i : i + 8192].encode())) for i in range(0, len(plain), 8192))

    return min((size(c), lang) for lang, c in dictionaries.items())[1]


def test_language_query_equals_a_plain_classifier(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    known = langid.learn(rows, learned("doc_id", 5))
    shortest = min(map(len, known.values()))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(rows, {k: c[:shortest] for k, c in known.items()}).collect()}
    for r in rows.collect():
        assert got[r["doc_id"]] == plain_language(r["text"], {k: c[:shortest] for k, c in known.items()})


def plain_language_of_any_lengths(text, dictionaries):
    """Dictionaries of unequal lengths: each length, of the longest halved, meets the leader's cut to that length."""
    import zstandard

    plain = langid.normalised(text or "")
    if not any(map(str.isalpha, plain)):
        return "und"

    def size(content):
        coder = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        return sum(len(coder.compress(plain[i : i + 8192].encode())) for i in range(0, len(plain), 8192))

    lengths = {}
    for lang, content in dictionaries.items():
        n = max(map(len, dictionaries.values()))
        while n > len(content):
            n //= 2
        lengths[lang] = n
    cost = {}
    for n in sorted(set(lengths.values()), reverse=True):
        shift = 0
        if cost:
            lead = min(cost, key=lambda x: (cost[x], x))
            shift = cost[lead] - size(dictionaries[lead][:n])
        cost |= {lang: size(dictionaries[lang][:n]) + shift for lang in lengths if lengths[lang] == n}
    return min((n, lang) for lang, n in cost.items())[1]


def test_language_with_unequal_dictionaries_and_very_long_texts(spark, docs, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    known = langid.learn(rows, learned("doc_id", 5))
    cut = {lang: content[: len(content) // (1, 3, 9, 20)[i]] for i, (lang, content) in enumerate(sorted(known.items()))}
    texts = [r["text"] for r in rows.limit(60).collect()]
    texts += [" ".join(texts[:30]) * 20, "x" * 300_000, " " * 300_000 + "a"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs(texts), cut).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_language_of_any_lengths(t, cut)


def test_too_many_languages_are_an_error(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    table = docs([]).unionByName(docs([(1, "some text")], lang="a"))
    for lang in "bcd":
        assert set(langid.learn(table, F.lit(True))) == set("abcd"[: "abcd".index(lang)])
        table = table.unionByName(docs([(1, f"text of {lang}")], lang=lang))
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.learn(table, F.lit(True))


def test_tokens_of_very_long_texts(spark, docs):
    """A megabyte without a space, and with them, against the library."""
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefghijklmnop", k=1_000_000)), " ".join("".join(rng.choices("etaoin shrdlu", k=9)) for _ in range(100_000)), "é" * 400_000, " " * 500_000]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs(texts), MODEL).collect()}
    assert [got[i] for i in range(len(texts))] == [len(library.encode(t)) for t in texts]


def test_languages_that_are_rare_long_or_many_are_learned(spark, docs):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabularies = {f"l{k:02}": ["".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(40)] for k in range(70)}
    draw = lambda lang, n: " ".join(rng.choices(vocabularies[lang], k=n))
    train = docs([])
    for k, lang in enumerate(vocabularies):
        # The first has only long texts, the second little text, the third much.
        texts = [draw(lang, {0: 4000, 1: 60, 2: 600}.get(k, 120)) for _ in range({0: 3, 1: 1, 2: 200}.get(k, 4))]
        train = train.unionByName(docs([(10_000 + 1000 * k + 5 * i + 1, t) for i, t in enumerate(texts)], lang=lang))
    known = langid.learn(train.coalesce(4), F.lit(True))
    assert set(known) == set(vocabularies) and len(known["l02"]) > 50 * len(known["l01"])
    asked = [(lang, draw(lang, 25)) for lang in vocabularies for _ in range(3)]
    got = langid.identify(docs([t for _, t in asked]), known).collect()
    right = [r["lang_pred"] == asked[r["doc_id"]][0] for r in got]
    assert np.mean(right) > 0.97
    assert all(ok for ok, (lang, _) in zip(right, asked, strict=True) if lang in ("l00", "l01", "l02"))


def test_quality_sum_of_squares_equals_pairs():
    rng = np.random.default_rng(2)
    machine = quality.fit([*map(quality.features, ["a b c", "x y z !!", "a a a a"])], [1, 0, 0], epochs=2)
    machine.factors = rng.normal(size=machine.factors.shape)
    index, value = machine.vector("a b c d e")
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j] for i in range(len(index)) for j in range(i)
    )
    assert abs(machine.raw(index, value) - (machine.bias + machine.weights[index] @ value + pairs)) < 1e-9


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    good, bad = ([r for r in rows.collect() if r["quality"] == y] for y in (1, 0))
    assert min(r["score"] for r in good) > max(r["score"] for r in bad)  # of every pair the good one scores higher
    assert all(r["predicted"] for r in good) and np.mean([r["predicted"] for r in bad]) < 0.35


def test_quality_edge_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (1, 0, 0), (9, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    machine = quality.learn(docs([(1, "good text"), (2, None), (9, "x")]), labels, learned("doc_id", 5))
    out = quality.score(docs([None, "", "word", "w " * 50000]).withColumn("y", F.lit(1)), machine).collect()
    assert all(0 <= r["score"] <= 1 for r in out) and out[0]["score"] == out[1]["score"]
    nothing = quality.learn(docs([]), labels.limit(0), learned("doc_id", 5))
    assert nothing.score("anything") == 0.5


BENCH = [(1, "The quick brown fox jumps over the lazy dog near the river bank"), (2, "If Anna buys 12 kg of rice and Bob buys 7 kg of rice how much rice do Anna and Bob have"), (3, "short item"), (4, None), (5, "five words make an item")]


def test_decontamination(spark, docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    texts = [
        "intro. the QUICK brown fox, jumps over the lazy dog near the river bank! outro",
        "If Carla buys 30 kg of rice and Dave buys 5 kg of rice how much rice do Carla and Dave have",
        "If Carla buys 30 kg of rice and Dave buys 5 kg of rice how much rice do Erik and Zoe have",
        "short item",
        "1 2 3 4 5 6 7 8 9 10 11 12 13 14",
        None,
        "",
        "we know that five words make an item too",
        "the quick brown fox jumps over a different thing entirely and goes home",
    ]
    found = decontam.contaminated(docs(texts), bench)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert (0, 1) in got and (1, 2) in got and (7, 5) in got and (3, 3) in got
    assert not {d for d, _ in got} & {4, 5, 6, 8}
    changed = {r["doc_id"]: r["changed_slots"] for r in found.collect()}
    assert changed[1] > 0
    assert (2, 2) not in got  # Anna stands for two names there
    assert decontam.contaminated(docs([]), bench).count() == 0
    assert decontam.contaminated(docs(texts), bench.limit(0)).count() == 0
    kept = {r["doc_id"] for r in decontam.clean(docs(texts), bench).collect()}
    assert kept == {2, 4, 5, 6, 8}


def test_canonical_templates():
    canonical = decontam.Canonical()
    t = canonical("The train from Paris. Berlin pays 1,200 km at 50 % or 5 kg % in Rome 3rd KG")
    assert t.text(0, len(t)) == "the train from <name> berlin pays <num> <unit> at <num> <unit> or <num> <unit> in <name> <num> <unit>"
    assert len(canonical("")) == len(canonical("... % !")) == 0


def test_canonical_equals_a_plain_reading():
    from plain import plain_template

    rng = random.Random(2)
    pieces = ["12kg", "3x", "3rd", "3rds", "1,200.5", "1.", "7:30", "IBM", "NASA", "Anna", "kg", "KG", "A", "I", "%", ".", "!", "\n", "h2o", "v1.2", "é", "Éa", "ÉA", "_", "x_y", "²", "٣", "5", "and", "4%", "/", ":", "1st2"]
    canonical = decontam.Canonical()
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice([" ", " ", "", "  "]) for _ in range(rng.randint(0, 12)))
        t = canonical(text)
        assert (t.words(0, len(t)), t.slot.tolist(), t.capital) == plain_template(text), text


def test_questions_asked_again_with_other_values(spark, docs):
    items = ["If Anna buys 12kg of rice, how much does she carry home in all?", "What is 12 + 30?", "Which x solves 3x plus 4 equals 10 for us?", "IBM sold 30 servers to NASA in one year, at what price?"]
    again = ["If Bertha buys 7kg of rice, how much does she carry home in all?", "What is 9 + 41?", "Which x solves 5x plus 2 equals 17 for us?", "AMD sold 45 servers to ESA in one year, at what price?"]
    other = ["What is an IBM server", "The sum 9 + 41 is what?", "Which x solves it for us", "Nobody sold servers to anyone in one year"]
    bench = spark.createDataFrame(list(enumerate(items)) + [(9, items[1])], "item_id long, text string")
    table = docs([f"He asked: {t} Then he left." for t in again] + other)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(table, bench).collect()}
    assert got == {(i, i) for i in range(4)} | {(1, 9)}
    assert {r["doc_id"] for r in decontam.clean(table, bench).collect()} == {4, 5, 6, 7}


def test_clean_leaves_out_what_contaminated_finds(spark, docs):
    """One-word items in very many places and repeated items are met once for each text."""
    rng = random.Random(8)
    items = [(i, "the") for i in range(40)] + [(50 + i, t) for i, t in enumerate(["rice 5 kg now", "Anna and Bob", "buys 3 apples"])]
    texts = ["the " * 3000, "a 7 the", "no such word", "rice 9 kg now", "he buys 8 apples", None, ""] + [" ".join(rng.choices("rice 5 9 kg now buys apples Anna and Bob the".split(), k=6)) for _ in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs(texts)
    found = {r["doc_id"] for r in decontam.contaminated(table, bench).select("doc_id").distinct().collect()}
    assert found == {k for k, _ in brute_leaks(texts, items)}
    assert {r["doc_id"] for r in decontam.clean(table, bench).collect()} == set(range(len(texts))) - found


def test_decontamination_slots_must_agree(spark, docs):
    bench = spark.createDataFrame([(1, "give 5 apples and 5 pears to both of them now")], "item_id long, text string")
    got = {r["doc_id"] for r in decontam.contaminated(docs(["give 8 apples and 8 pears to both of them now", "give 8 apples and 9 pears to both of them now"]), bench).collect()}
    assert got == {0}


def test_decontamination_tells_words_of_one_hash_apart(spark, docs):
    assert decontam._hash("plumless") == decontam._hash("buckeroo")  # crc32 is cheap, and only lets windows through to the join
    text = "the {} cat sat on the mat all day"
    bench = spark.createDataFrame([(1, text.format("plumless"))], "item_id long, text string")
    found = decontam.contaminated(docs([text.format("plumless"), text.format("buckeroo")]), bench)
    assert [r["doc_id"] for r in found.collect()] == [0]


def test_decontamination_repeated_rows(spark, docs):
    bench = spark.createDataFrame(BENCH[:1], "item_id long, text string")
    rows = docs([(1, BENCH[0][1]), (1, BENCH[0][1]), (None, BENCH[0][1])]).withColumn("key", F.lit("x")).withColumn("item_id", F.lit(7))
    assert decontam.contaminated(rows, bench).count() == 3
    assert decontam.clean(rows, bench).columns == rows.columns


def test_decontamination_equals_brute_force_over_all_windows(spark, docs):
    items = [
        (1, "3 4 5 6 7 8 9 10 11 12"),
        (2, "Anna Bell Carl Dora Emil Fritz Gina Hugo"),
        (3, "hi"),
        (4, "Paris has 3 rivers and 2 old bridges"),
        (5, "If Anna buys 12 kg of rice and Bob buys 7 kg of rice how much rice do Anna and Bob have"),
        (6, ""),
        (7, "?! ."),
        (8, "two 2"),
        (9, "Paris has 3 rivers and 2 old bridges"),
    ]
    rng = random.Random(6)
    words = "Anna Bob 3 4 5 12 7 kg of rice and buys . ! hi how much do have Paris rivers old bridges has the 2".split()
    texts = [t for _, t in items] + [
        "numbers: 3 4 5 6 7 8 9 10 11 12 end",
        "list of Anna Bell Carl Dora Emil Fritz Gina Hugo here",
        "he asked: Paris has 3 rivers and 2 old bridges?",
        "he asked: Rome has 5 rivers and 9 old bridges?",
        "Rome has 5 rivers and 9 old bridges",
        "If Carla buys 30 kg of rice and Dave buys 5 kg of rice how much rice do Carla and Dave have",
        "say hi to all",
        "x " * 20000 + "3 4 5 6 7 8 9 10",
        None,
    ]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(120)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs(texts), bench).collect()}
    assert got == brute_leaks(texts, items)
    assert {(9, 1), (10, 2), (11, 4), (12, 4), (15, 3), (16, 1)} <= got


def test_decontamination_filter_follows_the_items(spark):
    few = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    many = spark.createDataFrame([(i, " ".join(f"w{i * 7 + j}" for j in range(12))) for i in range(4000)], "item_id long, text string")
    sizes = [len(decontam.window_filter(decontam.items_of(x.selectExpr("string(item_id) as item_key", "text"), 8))[0]) for x in (few, many)]
    assert sizes[0] == decontam.LEAST_BITS // 8 and sizes[1] > 4 * sizes[0]


def brute_base(rows):
    cut = lambda t: [*(t or "").encode().lower().split(), lm.END]
    counts = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update(cut(t))
    n, v = sum(counts.values()), len(counts)
    below = math.log10(n + 0.1 * (v + 1)) if n else math.log10(0.1)
    return n, [
        (i, len(cut(t)), sum(counts[w] > 0 for w in cut(t)), sum(math.log10(counts[w] + 0.1) - below for w in cut(t))) for i, t in rows
    ]


def test_lm_base_is_exact_with_and_without_frequent_tokens(spark, docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "É".lower(), "<end>"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(60)] + [(70, None), (71, ""), (None, "W1 w2 unseen"), (5, "w1")]
    n, expected = brute_base(rows)
    for frequent in (0, 7, 1000):
        got = lm.score_texts(docs(rows), learned("doc_id", 10), frequent=frequent).collect()
        key = lambda x: (x[0] is None, x[0] or 0, round(x[3], 6))
        have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
        for a, b in zip(have, sorted(expected, key=key), strict=True):
            assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-9
        assert {r["train_tokens"] for r in got} == {n}


def test_lm_filter_levels(spark, docs):
    rows = docs([(1, "a " * 40 + "b b b c")])
    shape = lm.Segments(1000)
    rows = rows.select(F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("u"), F.col("text").cast("binary").alias("t"), F.spark_partition_id().alias("p"))
    parts = {}
    for r in rows.mapInArrow(lm._sent(shape, lm.SUMMED), lm._SENT).collect():
        parts.setdefault(r["segment"], []).append((bytes(r["low"]), bytes(r["rest"])))
    whole = {s: shape.answered(s, p)[0] for s, p in parts.items()}  # the filter, in one process

    def read(keys):
        segments = (keys >> np.uint64(shape.inner)).tolist()
        return [int(lm.levels(keys[i : i + 1], shape.block(keys[i : i + 1]), whole[s])[0]) if s in whole else 0 for i, s in enumerate(segments)]

    assert read(lm.mixed(lm.hashes([b"a", b"b", b"c", b"zz"])))[:3] == [6, 2, 1]
    pair = lm.bigrams(lm.hashes([b"a", b"a", b"b"]), np.array([0]))
    assert read(pair[1:]) == [6, 1]


def test_lm_packed_counts_come_back():
    rng = np.random.default_rng(9)
    for bits, n in ((48, 0), (40, 1), (40, 5000), (12, 4000), (8, 256)):
        keys = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        counts = rng.integers(1, 2000, len(keys))
        got = lm.unpack(*lm.pack(keys, counts, bits))
        assert (got[0] == keys).all() and (got[1] == counts).all()


def test_lm_vocabulary_starts_anew():
    vocabulary = lm.Vocabulary(lambda new: (lm.hashes(new),))
    vocabulary.KEPT = 10
    for k in range(30):
        words = [b"%d" % (k * j % 17) for j in range(8)]
        numbers = vocabulary(words)
        assert (vocabulary.columns[0][numbers] == lm.hashes(words)).all()


def test_lm_prefers_its_own_language_and_handles_no_training(spark, docs):
    train = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(1, 40)]
    got = {r["doc_id"]: r for r in lm.score_texts(docs([*train, (100, "the cat sat on the rug"), (101, "rug the on sat cat the")]), learned("doc_id", 10)).collect()}
    assert got[100]["score"] > got[101]["score"] and got[100]["n_tokens"] == 7
    empty = lm.score_texts(docs([(1, "a b")]), F.lit(False)).collect()[0]
    assert empty["train_tokens"] == 0 and empty["n_known"] == 0 and abs(empty["base_score"]) < 1e-9
    assert lm.score_texts(docs([]), learned("doc_id", 10)).count() == 0


def plain_scores(rows, counted=None):
    """The interpolated model with counts at the middle of their levels, or as ``counted``, without a filter."""
    cut = lambda t: [*(t or "").encode().lower().split(), lm.END]
    one, two = Counter(), Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            one.update(cut(t))
            two.update(zip([None, *cut(t)], cut(t)))
    n, v = sum(one.values()), len(one)
    read = counted or (lambda c: (2 ** (c.bit_length() - 1) * (2 ** c.bit_length() - 1)) ** 0.5 if c else 0.0)
    for i, t in rows:
        total = 0.0
        for a, b in zip([None, *cut(t)], cut(t)):
            seen, alone = read(one[lm.END if a is None else a]), min(1.0, (read(one[b]) + 0.1) / (n + 0.1 * (v + 1)))
            p = 0.7 * min(1.0, read(two[a, b]) / seen) + 0.3 * alone if seen else alone
            total += math.log10(p)
        yield i, total


def test_lm_scores_equal_a_plain_model_over_many_batches(spark, docs):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randint(0, 60)))) for i in range(400)] + [(500, None), (None, "w1 w2")]
    expected = dict(plain_scores(rows))
    for summed in (300, lm.SUMMED):
        got = {r["doc_id"]: r["score"] for r in lm.score_texts(docs(rows), learned("doc_id", 10), summed=summed).collect()}
        assert set(got) == set(expected)
        # A false positive of the filter moves one n-gram of a text, and hardly any text has one.
        assert sum(abs(got[i] - expected[i]) > 1e-9 for i in got) <= 0.25 * len(got)
        assert np.mean([got[i] - expected[i] for i in got]) < 0.1


def test_lm_scores_are_close_to_those_of_exact_counts(spark):
    """On held-out texts, whose n-grams the filter has not seen, 0.02 a token in the mean."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    exact = dict(plain_scores(rows, float))
    for held in (True, False):
        part = [r for r in lm.score_texts(table, learned("doc_id", 10)).collect() if (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) == held]
        assert abs(np.mean([(r["score"] - exact[r["doc_id"]]) / r["n_tokens"] for r in part])) < 0.02


def test_lm_odd_rows(spark, docs):
    """Repeated rows and ids, null ids, very long texts and tokens, and extra columns with clashing names."""
    long = "x" * 100_000
    rows = [(1, f"a {long} b"), (1, f"a {long} b"), (1, "other text"), (None, long), (None, None), (12, "a b " * 100_000), (13, f"{long} {long}")]
    table = docs(rows).selectExpr("*", "1 as row", "2 as token", "3 as c", "4 as score", "5 as u", "6 as t", "7 as p")
    n, expected = brute_base(rows)
    for frequent in (1000, 0):  # with the long token broadcast by its digest, and without
        got = lm.score_texts(table, learned("doc_id", 10), frequent=frequent).collect()
        assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {n}
        key = lambda x: (x[0] is None, x[0] or 0, round(x[3], 4))
        have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
        for a, b in zip(have, sorted(expected, key=key), strict=True):
            assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, abs(b[3]))


def test_odd_rows_of_the_other_operators(spark, docs):
    """Null and repeated ids, null texts, repeated rows, and extra columns with clashing names."""
    rows = [(5, "All rights reserved."), (5, "All rights reserved."), (5, "the other text"), (None, "cc by 4"), (None, None), (6, "")]
    table = docs(rows).selectExpr("*", "1 as t", "2 as words", "3 as base", "4 as n_words", "5 as score", "6 as n_tokens", "7 as lang_pred", "8 as key", "9 as n_bytes")
    found = licenses.scan_licenses(table).select("doc_id", F.size("base").alias("n")).collect()
    assert sorted((r["doc_id"] or 0, r["n"]) for r in found) == [(0, 0), (0, 1), (5, 0), (5, 1), (5, 1), (6, 0)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counted = tokens.count_tokens(table, MODEL).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in counted) == sorted((i or 0, len(library.encode(t or ""))) for i, t in rows)
    known = langid.learn(table, F.lit(True))
    named = langid.identify(table, known).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in named) == [(0, "en"), (0, "und"), (5, "en"), (5, "en"), (5, "en"), (6, "und")]
    leaks = decontam.contaminated(table, docs([(1, "cc by 4")]).selectExpr("doc_id as item_id", "text", "1 as doc_id", "2 as template")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in leaks] == [(None, 1)]


def test_licence_seeds_miss_nothing_that_a_full_search_finds(spark):
    """Every notice whose bounded-error pattern matches somewhere in a whole text is told, or lies in a longer one."""
    rng = random.Random(14)
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).select("text").collect()]
    texts = sorted(texts, key=len)[:80]
    for notice, _ in licenses.NOTICES * 6:  # with a few letters changed, dropped and doubled
        w = list(notice)
        for _ in range(rng.randint(0, len(notice) // 12 + 1)):
            i = rng.randrange(len(w))
            w[i] = rng.choice(["", w[i] * 2, "é", "q"])
        texts.append(f"{rng.choice(texts)[:200]} {''.join(w)} {rng.choice(texts)[:100]}")
    search = licenses.Scanner()
    hits = 0
    for t in texts:
        line = f" {b' '.join(licenses.words_of(t.encode())).decode()} "
        told = search.fuzzy(line)
        for notice, label, _, pattern in search.notices:
            if m := pattern.search(line):
                hits += 1
                first = line.count(" ", 0, m.start() + 1) - 1
                assert any(x[0] == label or (x[4] > len(notice) and x[1] <= first + 1 and first - 1 <= x[2]) for x in told), (label, t[-400:])
    assert hits > 100


def test_licence_titles_and_letters_beyond_ascii(spark, docs):
    texts = ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution-ShareAlike", "released undér thé MIT license"]
    got = {r["doc_id"]: [(n["label"], n["errors"]) for n in r["notices"]] for r in licenses.scan_licenses(docs(texts)).collect()}
    assert got == {0: [("cc-by-nc-sa", 0)], 1: [("cc-by", 0)], 2: [("cc-by-sa", 0)], 3: [("mit", 2)]}


def test_licences_in_a_text_of_many_hits():
    """200,000 exact phrases and 20,000 notices in one text: their words are counted on, not anew for each hit."""
    import time

    scanner = licenses.Scanner()
    for piece, n, each in ((b"cc by ", 200_000, 1), (b"released under the mit licence yes ", 20_000, 0)):
        scanner(piece * 50)
        began = time.process_time()
        found = scanner(piece * n)
        took = time.process_time() - began
        few = scanner(piece * 30)
        assert len(found["base"]) == each * n and (not each or [x["word"] for x in found["base"][:3]] == [0, 2, 4])
        if each:
            assert found["base"][-1]["word"] == 2 * n - 2
        assert len(found["notices"]) == len(few["notices"]) // 30 * n
        assert took < 8, took


@pytest.mark.parametrize("tokens_", [200_000, 10**9, 10**11, 10**13])
def test_lm_filter_has_no_greatest_size(tokens_):
    """One segment, filled as densely as they come (0.9 entries a token), read back, and asked for what it has not."""
    rng = np.random.default_rng(3)
    shape = lm.Segments(tokens_)
    assert lm.filter_bits(tokens_) >= 32 * tokens_ and shape.count * shape.own * lm.BLOCK == lm.filter_bits(tokens_)
    segment = shape.count - 3
    first = np.uint64(segment) << np.uint64(shape.inner)
    keys = np.unique(rng.integers(0, 1 << shape.inner, int(0.9 * tokens_ / shape.count), dtype=np.uint64)) + first
    bits = shape.filled(keys, np.ones(len(keys), np.int64))
    block = shape.block(keys)
    assert len(bits) == shape.own * lm.BLOCK // 8 <= 1 << 27 and block.max() < shape.own and (np.diff(block.astype(np.int64)) >= 0).all()
    held = np.bincount(block.astype(np.int64), minlength=shape.own)
    assert held.max() < 10 * held.mean() + 20  # blocks are filled evenly
    some = keys[:: max(1, len(keys) // 50_000)]
    assert (lm.levels(some, shape.block(some), bits) >= 1).all()
    unseen = rng.integers(0, 1 << shape.inner, 50_000, dtype=np.uint64) + first
    unseen = unseen[~np.isin(unseen, keys)]
    assert (lm.levels(unseen, shape.block(unseen), bits) > 0).mean() < 0.01
    cut = list(shape.cut(np.sort(np.r_[keys[:5], some[:5] - first]), np.ones(10, np.int64)))
    assert [c[0] for c in cut] == [0, segment]


def test_lm_rows_between_batches_and_segments_follow_the_corpus():
    rows = [n / (lm.SUMMED * lm.growth(n)) * lm.segments_of(n) / n for n in (2**34, 2**38, 2**44, 2**50)]
    assert max(rows) < 2.1 * min(rows)


def test_held_out_of_null_ids(spark, docs):
    row = docs([(None, "x")]).select(held_out("doc_id", 5), learned("doc_id", 5)).first()
    assert tuple(row) == (False, False)

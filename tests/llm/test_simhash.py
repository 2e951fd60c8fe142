import random

import numpy as np
import xxhash

from marketloom.llm import simhash
from marketloom.llm.components import connected_components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(values, radius=3):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_fingerprint_matches_definition():
    rng = random.Random(3)
    texts = ["", "One", "one TWO", "a b c", "Ä ä É x y z", " \x0b\x0c tab\there "]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))) for _ in range(40)]
    for t in texts:
        assert simhash.simhash(t.encode()) == brute_fingerprint(t), t


def test_long_text_is_hashed_in_steps(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000)).encode()
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "STEP", 64)
    assert simhash.simhash(text) == whole


def test_bit_sliced_distances_match_popcount():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = base[:60] ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    values = np.unique(np.concatenate([base, near]))
    for radius in (0, 1, 2, 3, 5):
        rows, hits = simhash.within(values, simhash.bit_planes(values), len(values), radius)
        got = np.zeros((len(values), len(values)), bool)
        for r, h in zip(rows, hits, strict=True):
            got[r] = np.unpackbits(h.view(np.uint8), bitorder="little")[: len(values)]
        exact = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        assert (got == exact).all()


def test_components_equal_brute_force(spark):
    rng = random.Random(11)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in list(values):  # chains and dense balls
        for _ in range(4):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            values.append(v)
    hot = rng.getrandbits(64)
    values += [hot ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12) if a < b]
    values = sorted(set(values))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    marks = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = simhash.links(marks, chunk=16, block=32)  # forces split buckets
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    expected = brute_components(values)
    groups = {}
    for s, e in zip(signed, expected, strict=True):
        groups.setdefault(e, []).append(s)
    for members in groups.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_edge_cases(spark, docs):
    rows = docs([(5, None), (3, ""), (9, " \t "), (7, "one two three four"), (7, "one two three four"), (None, "one two three four"), (None, "else")])
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(rows).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (7, 7), (None, 7), (None, None)}
    assert simhash.near_duplicates(rows).count() == 7
    assert simhash.near_duplicates(docs([])).count() == 0


def test_extra_columns_do_not_clash(spark, docs):
    rows = docs(["a b c d", "a b c d"]).selectExpr("*", "1 as fp", "2 as component_id", "3 as node")
    assert {r["component_id"] for r in simhash.near_duplicates(rows).collect()} == {0}


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160))

"""Clustering, set join and manifest against plain versions, and their odd rows."""

import hashlib
import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.llm import centroids, groups, merkle, setjoin
from marketloom.llm.common import remainder
from marketloom.llm.simhash import Shingles

# ---- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, siblings of each leaf from below to above)."""
    level, at, found = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for leaf, i in enumerate(at):
            other = i ^ 1
            if other < len(level):
                found[leaf].append((other < i, level[other]))
            else:
                found[leaf].append(None)
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], found


def plain_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    trees = {}
    for lang, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in members])
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    root, over = plain_tree([trees[lang][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for r, way in zip(groups[lang], trees[lang][1], strict=True):
            way = way + over[place]
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                changed[3] += 1
            now = plain_leaf(changed)
            for step in way:
                now = sha(now) if step is None else sha(step[1] + now if step[0] else now + step[1])
            proof = sha("".join(s[1] for s in way if s))
            out.append((r[0], plain_leaf(r), trees[lang][0], root, proof, now, now == root))
    return sorted(out, key=str)


def manifest(df):
    rows = merkle.verified_manifest(df, changed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, where=remainder("doc_id", 7) == 0)
    return sorted(map(tuple, rows.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def some_rows(n, langs, seed=1):
    rng = random.Random(seed)
    # a third of the rows or more are of the first language
    return [(i, rng.choice(["a", None]), langs[0] if rng.random() < 0.4 else rng.choice(langs), rng.choice([None, i, 2**63 - 1]), rng.choice([None, "", f"täxt {i}"])) for i in range(n)]


@pytest.mark.parametrize("stride", [2, 12])
@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, [None]), (57, ["en", "de", None, "", "é"]), (300, [None, *(f"l{i}" for i in range(13))])])
def test_manifest_equals_plain(spark, monkeypatch, stride, n, langs):
    monkeypatch.setattr(merkle, "STRIDE", stride)
    rows = some_rows(n, langs)
    assert manifest(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_manifest_of_odd_tables(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)) == []
    rows = [(None, None, None, None, None)] * 3 + [(None, "s", "en", 1, "x")] * 2 + [(7, "s", "en", 1, "y" * 300_000), (7, "s", "en", 2, "")] * 2
    plain = plain_manifest(rows)
    assert manifest(spark.createDataFrame(rows, SCHEMA)) == plain
    clashing = spark.createDataFrame(rows, SCHEMA)
    for name in ("g", "pos", "n", "digest", "segment", "root", "block", "range", "row", "later"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert manifest(clashing) == plain


def test_manifest_notices_every_change(spark):
    rows = some_rows(40, ["en", "de"], 3)
    df = spark.createDataFrame(rows, SCHEMA)
    same = merkle.verified_manifest(df)
    assert same.where("verified").count() == 40
    other = merkle.verified_manifest(df, changed={"text": F.concat(F.coalesce("text", F.lit("")), F.lit("!"))})
    assert other.where("verified").count() == 0


@given(st.integers(1, 70), st.data())
@settings(max_examples=60, deadline=None)
def test_fold_gives_the_root(n, data):
    leaves = [sha(str(i)) for i in range(n)]
    root, ways = plain_tree(leaves)
    i = data.draw(st.integers(0, n - 1))
    segment = b"".join(bytes.fromhex(s[1]) for s in ways[i] if s)
    assert merkle.fold(bytes.fromhex(leaves[i]), i, n, segment).hex() == root
    assert merkle.depth(n) == len(ways[i])


# ---- clustering


def plain_clusters(rows, k=16, rounds=3, size=64):
    def component(x):
        return math.floor(64 * max(min(x, 2.0**21), -(2.0**21)))

    kept = [
        (i, [component(x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    middle = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            middle[j] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    top = 2**63 - 1
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(k)}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, c, d, min(top, inertia[c]), min(top, sum(inertia.values())), marks[c]) for i, c, d in found), key=str)


VECTORS = "vec_id long, embedding array<double>"


def clusters(df, **kw):
    return sorted(map(tuple, centroids.cluster(df, **kw).collect()), key=str)


def test_clusters_equal_plain(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(0, 1, (9, 64))
    rows = [(i, (middle[i % 9] + rng.normal(0, 0.1 + i % 3, 64)).tolist()) for i in range(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # a hot vector
    rows += rows[:5]
    assert clusters(spark.createDataFrame(rows, VECTORS).repartition(5)) == plain_clusters(rows)


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0] * 63), (4, [0.0] * 63 + [None]), (5, [nan] + [0.0] * 63), (6, [inf] + [0.0] * 63)]
    df = spark.createDataFrame(rows, VECTORS)
    assert clusters(df) == [] and clusters(df.limit(0)) == []
    rows += [(7, [0.0] * 64), (8, [0.0] * 64), (None, [0.5] * 64), (None, [0.5] * 64), (9, [1e300] * 64), (10, [-1e300] * 64)]
    rows += [(11, [x / 64 for x in range(64)])] * 3
    df = spark.createDataFrame(rows, VECTORS)
    plain = plain_clusters(rows)
    assert clusters(df) == plain
    for name in ("id", "e", "near", "cluster", "distance", "n"):
        df = df.withColumn(name, F.lit("x"))
    assert clusters(df) == plain


def test_bounds_are_bounds_and_leave_out():
    rng = np.random.default_rng(8)
    spread = rng.integers(-3000, 3000, (12, 16))
    x = spread[rng.integers(0, 12, 500)] + rng.integers(-90, 90, (500, 16))
    start = x[rng.choice(500, 8, replace=False)]
    pivots = centroids.Pivots(start)
    for moved in (start, start + rng.integers(-60, 60, start.shape)):
        cached = pivots.distances(x)
        exact = np.stack([centroids.squared(x, c) for c in moved], axis=1)
        low = pivots.bounds(cached, moved)
        assert (low <= exact).all()
        best, found, measured = centroids.assign(x, cached, moved, pivots)
        assert (best == exact.argmin(axis=1)).all() and (found == exact.min(axis=1)).all()
        assert measured < 0.5 * exact.size


# ---- set join


def plain_sets(texts, words=4):
    out = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def plain_components(rows, percent=85):
    sets = plain_sets([t for _, t in rows])
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    out = []
    for (doc, _), s, x in zip(rows, sets, label, strict=True):
        ids = [d for (d, _), y in zip(rows, label, strict=True) if x == y and d is not None]
        out.append((doc, len(s), min(ids) if ids and s else doc))
    return sorted(out, key=str)


def joined(docs_df, **kw):
    return sorted(map(tuple, setjoin.components(docs_df, **kw).collect()), key=str)


def varied(rng, words, share):
    """Words with about a share of them replaced, dropped or doubled."""
    out = []
    for w in words:
        roll = rng.random()
        out += [] if roll < share / 3 else [w, w] if roll < share * 2 / 3 else [rng.choice("xyz") + w] if roll < share else [w]
    return out


def corpus(seed, n=240):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]  # that many texts share
    template = [rng.choice(vocabulary) for _ in range(120)]
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        elif kind == 1:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] + passage
        elif kind == 2:  # a third of the rows: near copies of one text, around the threshold
            words = varied(rng, template, rng.choice([0.01, 0.02, 0.04, 0.06]))
        elif kind == 3 and texts:
            words = varied(rng, rng.choice(texts), rng.choice([0.005, 0.02, 0.04]))
        elif kind == 4 and texts:
            words = [w.upper() for w in rng.choice(texts)]
        else:
            words = varied(rng, template, 0.02)
        texts.append(words)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed, chunk", [(1, 1024), (2, 8)])
def test_set_join_equals_brute_force(spark, docs, monkeypatch, seed, chunk):
    monkeypatch.setattr(setjoin, "CHUNK", chunk)
    monkeypatch.setattr(setjoin, "BROADCAST_ROWS", 0 if chunk == 8 else setjoin.BROADCAST_ROWS)  # texts are met by a shuffle
    texts = corpus(seed)
    rows = list(enumerate(texts))
    got = joined(docs(rows).repartition(3))
    assert got == plain_components(rows)
    assert len({c for _, _, c in got}) < 200


def test_second_groups_meet_all_pairs_that_are_apart(spark):
    rng = random.Random(3)
    rows = [(k, node, rng.choice([1, 1, 1, 2, node])) for k in range(6) for node in rng.sample(range(100), rng.randint(2, 60))]
    label = {n: x for _, n, x in rows}
    rows = [(k, n, label[n]) for k, n, _ in rows]
    met = spark.createDataFrame(rows, "k long, node long, label long")
    found = {}
    for g, node, _ in groups.second_groups(met, chunk=7).collect():
        found.setdefault(g, []).append(node)
    assert max(map(len, found.values())) < 60
    got = {p for g in found.values() for p in combinations(sorted(g), 2) if label[p[0]] != label[p[1]]}
    want = {tuple(sorted((a, b))) for (k, a, x), (m, b, y) in combinations(rows, 2) if k == m and x != y}
    assert got == want


def test_set_join_of_odd_rows(spark, docs):
    assert joined(docs([])) == []
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(5, None), (3, ""), (4, " \t\n"), (9, "one two"), (8, "ONE  two"), (7, "one two three"), (None, "a b c d e f g"), (2, "a b c d e f g")]
    rows += [(None, "null id alone"), (1, "x"), (1, "x"), (1, "y z"), (20, long), (10, long + " end"), (6, "é É à"), (12, "é é à")]
    plain = plain_components(rows)
    assert joined(docs(rows)) == plain
    clashing = docs(rows)
    for name in ("node", "k", "n", "g", "rk", "label", "keys", "bits", "component_id"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert joined(clashing) == plain


@given(st.integers(0, 10_000), st.integers(1, 3))
@settings(max_examples=15, deadline=None)
def test_trees_and_prefixes_lose_no_link(seed, common):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in rng.integers(1, 90, 25)]
    for s in list(sets):
        for r in (0.03, 0.08, 0.12):
            sets.append(np.unique(np.r_[s[rng.random(len(s)) > r], s[:1], rng.integers(0, 2**63, int(r * len(s) / 2), dtype=np.uint64)]))
    true = {p for p in combinations(range(len(sets)), 2) if setjoin.similar(sets[p[0]], sets[p[1]])}
    whole = [set(s.tolist()) for s in sets]
    assert true == {(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * len(whole[i] & whole[j]) >= 85 * len(whole[i] | whole[j])}
    left = set()
    for i, j in setjoin.candidates(np.array(list(map(len, sets))), [setjoin.signature(s) for s in sets], np.array([s[0] for s in sets])):
        left |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert true <= left
    rows = [(i, len(s), 0, setjoin.signature(s).tobytes()) for i, s in enumerate(sets)]
    few = {p for p in combinations(range(len(sets)), 2) if setjoin._pairs_of_few([rows[p[0]], rows[p[1]]], 85)[0]}
    assert true <= few
    known = np.unique(np.concatenate(sets)[::common])
    first = [set(setjoin.prefix(s, known, rng.integers(3, 9, len(known)) * 0 + 3).tolist()) for s in sets]
    assert all(first[i] & first[j] for i, j in true)


def test_traversal_leaves_out_whole_nodes(monkeypatch):
    """Clusters without anything in common part at inner nodes: few pairs of leaves are ever looked at."""
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(64)]
    sets = [b[rng.random(len(b)) > 0.02] for b in base for _ in range(8)]
    looked = []
    possible = setjoin._possible

    def counting(a, b, level, i, j, percent):
        looked.append((level == 0, len(i)))
        return possible(a, b, level, i, j, percent)

    monkeypatch.setattr(setjoin, "_possible", counting)
    near = np.repeat(np.arange(64), 8)
    found = sum(len(i) for i, _ in setjoin.candidates(np.array(list(map(len, sets))), [setjoin.signature(s) for s in sets], near))
    assert found >= 64 * 28
    assert sum(n for leaves, n in looked if leaves) < 0.1 * len(sets) ** 2 / 2


def test_parts_are_what_pairs_connect():
    left, right = np.array([5, 1, 2, 9]), np.array([1, 7, 3, 8])
    assert [sorted(p.tolist()) for p in groups.gathered(left, right, 10)] == [[1, 5, 7], [2, 3], [8, 9]]
    assert groups.gathered(left[:0], right[:0], 4) == []


def test_shingles_are_of_the_asked_words():
    assert len(Shingles(4)(b"a b c d e")) == 2 and len(Shingles(4)(b"a b")) == 1 and not len(Shingles(4)(b" "))

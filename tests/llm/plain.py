"""Plain versions of operators, one row at a time and all pairs, that tests hold results against."""

import hashlib
import re
import zlib

from marketloom.llm import quality, secrets
from marketloom.llm.decontam import NO_NAMES, UNITS


def plain_template(text):
    """(words in lower case, slots, whether the first word may be a name), read character by character.

    Slots are 0 for numbers, 1 for units behind numbers and percent signs, 2 for names, -1 for words.
    """
    text, i, tokens = text or "", 0, []
    digit = lambda c: c in set("0123456789")

    def more(i):
        """Behind marks that have digits right after them."""
        while i + 1 < len(text) and text[i] in ".,:/" and digit(text[i + 1]):
            i += 1
            while i < len(text) and digit(text[i]):
                i += 1
        return i

    while i < len(text):
        c, start = text[i], i
        if c in ".!?\n":
            tokens.append((c, "end"))
        elif c == "%":
            tokens.append((c, "percent"))
        elif digit(c):
            while i < len(text) and digit(text[i]):
                i += 1
            i = more(i)
            if text[i : i + 2] in ("st", "nd", "rd", "th") and not text[i + 2 : i + 3].isalnum():
                i += 2
            tokens.append((text[start:i], "num"))
            continue
        elif c.isalnum():
            while i < len(text) and text[i].isalnum():
                i += 1
            i = more(i)
            tokens.append((text[start:i], "word"))
            continue
        i += 1
    words, slots, fresh, behind, capital = [], [], True, False, False
    for token, kind in tokens:
        if kind == "end":
            fresh = True  # what comes next begins a sentence, and may still be behind a number
            continue
        if kind == "percent" and not behind:
            continue
        slot = -1
        name = kind == "word" and token.lower() not in UNITS | NO_NAMES and token[0].isupper() and token[1:2].islower()
        capitals = kind == "word" and token.lower() not in UNITS | NO_NAMES and len(token) > 1 and token.isupper()
        if kind == "num":
            slot = 0
        elif kind == "percent" or (token.lower() in UNITS and behind):
            slot = 1
        elif capitals or (name and not fresh):
            slot = 2
        if not words:
            capital = name and not capitals
            slot = -1 if name and not capitals else slot
        words.append(token.lower())
        slots.append(slot)
        fresh, behind = False, kind == "num"
    return words, slots, capital


def brute_leaks(texts, items, window=8):
    """(text, item) pairs by comparing all windows, one by one."""
    read = plain_template

    def hits(doc, item, size):
        """Slots by alignment, and whether a window is the same word for word."""
        out = {}
        (d, ds, _), (w, ws, capital) = doc, item
        for j in range(len(w) - size + 1):
            ways = [ws[j : j + size]]
            if j == 0 and capital and ws[0] < 0:
                ways.append([2, *ws[1:size]])
            for i in range(len(d) - size + 1):
                a, b = d[i : i + size], w[j : j + size]
                slots, literal = out.setdefault(i - j, (set(), []))
                if a == b:
                    literal.append(1)
                mine = ds[i : i + size]
                full = sum(s >= 0 for s in mine)
                if full and 2 * full <= size and size - full >= 2:
                    for way in ways:
                        if way == mine and all(x == y for x, y, s in zip(a, b, mine) if s < 0):
                            slots.update((s, x, y) for x, y, s in zip(a, b, mine) if s >= 0)
        return out

    found = set()
    for k, t in enumerate(texts):
        for n, (_, item) in enumerate(items):
            doc, own = read(t), read(item)
            size = min(window, len(own[0]))
            if not size:
                continue
            for slots, literal in hits(doc, own, size).values():
                one = len({(s, x) for s, x, _ in slots}) == len(slots) == len({(s, y) for s, _, y in slots})
                if literal or (slots and one):
                    found.add((k, items[n][0]))
    return found


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def similar(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_groups(texts, least=0.8):
    """Smallest place that near-copies reach from each text."""
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if group[i] != group[j] and similar(sets[i], sets[j]) >= least:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def keep_quality(rows, labels):
    text = {r["doc_id"]: r["text"] for r in rows}
    known = [(hashlib.md5(str(i).encode()).hexdigest(), i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 and text.get(i) is not None]
    found = [quality.features(text[i]) for _, i, _ in sorted(known)]
    machine = quality.fit([(i, v.astype("f4").astype(float), s) for i, v, s in found], [y for *_, y in sorted(known)])
    return [r for r in rows if machine.score(r["text"] or "") >= 0.3]


def drop_near(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0))
    rows = [rows[i] for i in order]
    return [r for i, (r, g) in enumerate(zip(rows, near_groups([r["text"] for r in rows]), strict=True)) if g == i]


def drop_leaks(rows, items):
    found = {k for k, _ in brute_leaks([r["text"] for r in rows], items)}
    return [r for k, r in enumerate(rows) if k not in found]


def redact(rows):
    out = []
    for r in rows:
        text, covered = r["text"] or "", set()
        starts = set()
        for rule in secrets.RULES:
            for m in re.finditer(rule.pattern, text):
                if len(m.group(rule.group)) >= rule.least:
                    covered.update(range(m.start(), m.end()))
                    starts.add(m.start())
        if not covered:
            out.append(r)
            continue
        clean = "".join(
            ("[REDACTED]" if i - 1 not in covered else "") if i in covered else c for i, c in enumerate(text)
        )
        out.append(r | {"text": clean, "n_chars": len(clean)})
    return out


def targets(sizes, weights=(1, 2, 3), repeats=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > repeats * sizes[s] + 1e-9}
        if not over:
            return target | {s: w[s] * level for s in open_}
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mix(rows, repeats=3):
    """Rows that the mix takes, for rows with different ids."""
    rows = [r | {"size": len(words(r["text"]))} for r in rows]
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target, at, queue = targets(sizes), dict.fromkeys(sizes, 0), []
    key = lambda r: hashlib.md5(f"{'' if r['doc_id'] is None else r['doc_id']}|mix".encode()).hexdigest()
    for r in sorted(rows, key=key):
        at[r["source"]] += r["size"]
        for n in range(repeats):
            if r["size"] and target[r["source"]] > 0:
                queue.append(((n * sizes[r["source"]] + at[r["source"]]) / target[r["source"]], key(r), n, r))
    left, taken = sum(sizes.values()), {}
    for _, _, _, r in sorted(queue, key=lambda x: x[:3]):
        if r["size"] > left:
            break
        left -= r["size"]
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["size"]
    return [
        r | {"source_size": sizes[r["source"]], "target": float(target[r["source"]]), "taken": taken[r["doc_id"]]}
        for r in rows
        if r["doc_id"] in taken
    ]

"""Secret scan with a trigram inverted index, in DataFrame functions alone.

1. ``trigram_query`` reads a rule's regular expression and derives which trigrams any match must hold: an
   OR of clauses, each an AND of trigrams.
2. ``postings`` maps each trigram that some rule needs to the documents that hold it.
3. ``candidates`` intersects the postings of each clause and unites the clauses of a rule.
4. ``scan`` verifies candidates with the rule itself.  A rule without mandatory trigrams has every document
   as a candidate.

Letters are compared in lower case in the index, so it may name too many candidates, never too few.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``least`` is the fewest characters that group ``group`` of a match must have, else it is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(
    [*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")]
)
#: The three base kinds come first, in the order that breaks ties.
BASE = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Kinds that this scan adds: public token formats.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,250}"),
)
RULES = BASE + ADDED
REDACTED = "[REDACTED]"
#: Trigrams of a clause that are looked up at most; fewer name more candidates, never fewer.
CLAUSE_TRIGRAMS = 5
#: Matches of a text that are placed together.
FOLDED = 64
_MOST = 64  # strings that a mandatory part of a pattern may stand for before it is closed


def _runs(parsed) -> list[set[str]]:
    """Consecutive mandatory parts of a pattern; each holds every string that the part can be."""
    done: list[set[str]] = []
    open_: set[str] = {""}

    def close():
        nonlocal open_
        if open_ != {""}:
            done.append(open_)
        open_ = {""}

    def add(strings: set[str]):
        nonlocal open_
        if len(open_) * len(strings) > _MOST:
            close()
        open_ = {a + b for a in open_ for b in strings}

    for op, arg in parsed:
        if op is sre.LITERAL:
            add({chr(arg).lower()})
        elif op is sre.IN:
            chars = _members(arg)
            if chars is None or len(chars) > 8:
                close()
            else:
                add(chars)
        elif op is sre.SUBPATTERN or op is sre.BRANCH:
            ways = arg[1] if op is sre.BRANCH else [arg[3]]
            parts = [_runs(w) for w in ways]
            if all(len(p) <= 1 and _exact(w) for p, w in zip(parts, ways, strict=True)):
                add(set().union(*(p[0] if p else {""} for p in parts)))
            elif len(ways) == 1:
                close()
                done.extend(parts[0])
            else:
                close()
        elif op is sre.MAX_REPEAT or op is sre.MIN_REPEAT:
            low, high, inner = arg
            parts = _runs(inner)
            if high == 1 and len(parts) == 1 and _exact(inner):
                add(parts[0] | {""})
            else:
                close()
                if low:
                    done.extend(parts)
        else:
            close()
    close()
    return done


def _members(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 64:
            out.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return out


def _exact(parsed) -> bool:
    """Whether ``_runs`` tells all of what this pattern can be, with nothing left out."""
    for op, arg in parsed:
        if op is sre.LITERAL:
            continue
        if op is sre.IN and (m := _members(arg)) is not None and len(m) <= 8:
            continue
        if op is sre.SUBPATTERN and _exact(arg[3]):
            continue
        if op is sre.BRANCH and all(map(_exact, arg[1])):
            continue
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1 and _exact(arg[2]):
            continue
        return False
    return True


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of trigrams: a match needs all trigrams of at least one.  An empty list asks for a full scan."""
    clauses: list[frozenset[str]] = [frozenset()]
    for strings in _runs(sre_parse.parse(pattern)):
        ways = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() in ways:
            continue  # one way has no trigram, so none is mandatory here
        ways = {w for w in ways if not any(o < w for o in ways)}
        clauses = list({a | b for a, b in product(clauses, ways)})
    clauses = [c for c in clauses if not any(o < c for o in clauses)]
    if clauses == [frozenset()]:
        return []
    spread = [sorted(c)[:: -(-len(c) // CLAUSE_TRIGRAMS)] for c in clauses]
    return sorted({frozenset(c) for c in spread}, key=sorted)


def document_key(id_col: str, text_col: str) -> Column:
    """Equal for rows with the same id and text, which have the same secrets."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def postings(docs: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """(tri, key): the inverted index, for the trigrams that queries ask for, by their place in the list."""
    # The lower case is a column of its own, so that it is made once and not for every trigram.
    low = docs.select("key", F.lower(F.col(text_col)).alias("low"))
    held = F.array(*(F.when(F.col("low").contains(F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)))
    return low.select("key", F.explode(F.array_compact(held)).alias("tri"))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """(key, rules): bit r of ``rules`` is set where the postings of a clause of rule r meet."""
    at = {t: i for i, t in enumerate(trigrams)}
    rows = [
        (at[t], r, c, 1 << i, (1 << len(clause)) - 1)
        for r, clauses in queries.items()
        for c, clause in enumerate(clauses)
        for i, t in enumerate(sorted(clause))
    ]
    spark = index.sparkSession
    asked = spark.createDataFrame(rows, "tri int, rule int, clause int, bit long, need long")
    met = (
        index.join(F.broadcast(asked), "tri")  # a row per trigram of a rule: bounded by the rules
        .groupBy("key", "rule", "clause")
        .agg(F.bit_or("bit").alias("bits"), F.first("need").alias("need"))
        .where("bits = need")
    )
    return met.groupBy("key").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def _hits(text: Column, rule: Rule, order: int) -> Column:
    """Array of (gap before, length, keep) of the rule's matches, left to right."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = whole if not rule.group else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("w"), measured.alias("m")),
        lambda x: F.struct(
            F.char_length(x["g"]).cast("long").alias("gap"),
            F.char_length(x["w"]).cast("long").alias("size"),
            (F.char_length(x["m"]) >= rule.least).alias("keep"),
        ),
    )


def _folded(items: Column, kind: str, step, finish) -> Column:
    """Walks ``items``: ``step`` (place, item) gives the next place and a piece, ``finish`` (place, pieces) the result.

    Pieces are gathered in chunks, since each one that is appended to an array copies the array.
    """
    none, nones = (F.expr(f"cast(array() as array<{k}>)") for k in (kind, f"array<{kind}>"))
    last = F.greatest(F.lit(0), F.floor((F.size(items) - 1) / FOLDED).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * FOLDED + 1, FOLDED))

    def one(acc, x):
        at, piece = step(acc["at"], x)
        return F.struct(at.alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    def chunk(acc, part):
        done = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        more = F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))
        return more[0]

    start = F.struct(F.lit(0).cast("long").alias("at"), nones.alias("out"))
    return F.aggregate(chunks, start, chunk, lambda acc: finish(acc["at"], F.flatten(acc["out"])))


def _spans(hits: Column, rule: Rule, order: int) -> Column:
    """Array of (start, end, kind order, kind), code points, end exclusive; failing matches dropped."""

    def step(at, h):
        end = at + h["gap"] + h["size"]
        return end, F.struct((at + h["gap"]).alias("s"), end.alias("e"), h["keep"].alias("keep"))

    placed = _folded(hits, "struct<s:bigint,e:bigint,keep:boolean>", step, lambda _, pieces: pieces)
    return F.transform(
        F.filter(placed, lambda x: x["keep"]),
        lambda x: F.struct(x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e"), F.lit(rule.kind).alias("kind")),
    )


#: A pattern whose kept matches are the same and which most texts fail at once.  Matches of both rules are
#: whole runs of one class behind a fixed start, so asking for the length inside the pattern changes none.
_SHORTCUT = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(``docs`` columns, spans): spans is an array of structs (s, o, e, kind), by start, then rule order.

    An input column named spans is replaced.  At most 63 rules, a bit each.  Matches are leftmost and
    non-overlapping per rule.  A null text counts as empty; empty texts have no
    spans; repeated rows each return a row; a null id is kept.
    """
    if len(rules) > 63:
        raise ValueError(f"at most 63 rules, not {len(rules)}")
    rules = tuple(Rule(r.kind, _SHORTCUT.get(r.kind, r.pattern), r.group, r.least) for r in rules)
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for clause in q for t in clause})
    every = sum(1 << i for i in range(len(rules)) if i not in queries)
    columns = [c for c in docs.columns if c != "spans"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).alias("id"))
    rows = rows.select("row", "text", document_key("id", "text").alias("key"))
    if trigrams:
        found = candidates(postings(rows.select("key", "text"), trigrams), queries, trigrams)
        rows = rows.join(found, "key", "left").withColumn("rules", F.coalesce("rules", F.lit(0).cast("long")).bitwiseOR(F.lit(every).cast("long")))
    else:
        rows = rows.withColumn("rules", F.lit(every).cast("long"))
    empty = F.expr("cast(array() as array<struct<gap:bigint,size:bigint,keep:boolean>>)")
    for i, rule in enumerate(rules):
        asked = (F.col("rules").bitwiseAND(F.lit(1 << i)) != 0) & F.col("text").rlike(rule.pattern)
        rows = rows.withColumn(f"h{i}", F.when(asked, _hits(F.col("text"), rule, i)).otherwise(empty))
    spans = F.array_sort(F.concat(*(_spans(F.col(f"h{i}"), r, i) for i, r in enumerate(rules))))
    return rows.select("row", spans.alias("spans")).select(*(F.col("row")[c].alias(c) for c in columns), "spans")


def digest(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every stretch that spans cover replaced by ``[REDACTED]``; other characters stay."""

    def step(at, x):
        before = F.substring(text, (at + 1).cast("int"), (x["s"] - at).cast("int"))
        covered = (x["e"] <= at) | ((x["s"] < at) & (at > 0))  # inside the stretch before, or going on from it
        return F.greatest(at, x["e"]), F.when(covered, F.lit("")).otherwise(F.concat(before, F.lit(REDACTED)))

    def finish(at, pieces):
        return F.concat(F.array_join(pieces, ""), F.substring(text, (at + 1).cast("int"), F.lit(2147483647)))

    return F.when(F.size(spans) > 0, _folded(spans, "string", step, finish)).otherwise(text)

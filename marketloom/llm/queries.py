"""Registered queries of the operators, with their SQL where SQL can tell the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, decontam, langid, licenses, lm, merkle, mixing, quality, secrets, setjoin, simhash, sql, tokens
from .common import checkpointed, held_out, learned, remainder, table

ACCEPT = 0.3


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    words = F.transform("base", lambda x: x["word"])
    labels = F.transform("base", lambda x: x["label"])
    added = F.transform("notices", lambda x: x["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(labels))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(labels, added))).alias("labels"),
        "score",
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = langid.learn(docs, learned("doc_id", 5))
    found = langid.identify(docs, known)
    return found.select("doc_id", held_out("doc_id", 5).alias("held_out"), "lang_pred", "score", "reliable")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda x: x["o"] < len(secrets.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE]
    return secrets.scan(docs).select(
        "doc_id",
        *counts,
        F.sha2(secrets.digest(base).cast("binary"), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The words are counted once; from there on the rows are narrow.
    docs = checkpointed(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("words")))
    return mixing.mix(docs, size=F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality.learn(docs, table(spark, sf_dir, "labels"), learned("doc_id", 5))
    scored = quality.score(docs.select("doc_id", "text"), machine)
    return scored.select(
        "doc_id",
        held_out("doc_id", 5).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm.score_texts(docs, learned("doc_id", 10))
    return scored.select(
        "doc_id", held_out("doc_id", 10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.components(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}  # past the largest long, too
    return merkle.verified_manifest(docs, changed=tampered, where=remainder("doc_id", 7) == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_licenses,
        op3_language,
        op4_secrets,
        op5_tokens,
        op6_decontamination,
        op7_mixing,
        op8_neighbours,
        op9_quality,
        op10_lm,
        op11_centroids,
        op12_setjoin,
        op13_merkle,
    )
}


def _secrets_sql() -> str:
    lists, kinds = [], []
    for i, r in enumerate(secrets.RULES):
        p = r.pattern.replace("'", "''")
        lists.append(
            f"string_split_regex(t, '{p}') AS g{i}, regexp_extract_all(t, '{p}', 0) AS w{i},"
            f" regexp_extract_all(t, '{p}', {r.group}) AS m{i}"
        )
        start = (
            f"coalesce(list_sum(list_transform(g{i}[1:j], lambda x: length(x))), 0)"
            f" + coalesce(list_sum(list_transform(w{i}[1:j-1], lambda x: length(x))), 0)"
        )
        kinds.append(
            f"list_transform(list_filter(range(1, len(w{i}) + 1), lambda j: length(m{i}[j]) >= {r.least}),"
            f" lambda j: {{'s': CAST({start} AS BIGINT), 'o': {i}, 'e': CAST({start} + length(w{i}[j]) AS BIGINT), 'kind': '{r.kind}'}})"
        )
    join = "array_to_string(list_transform({0}, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"
    base = "list_filter(spans, lambda x: x.o < 3)"
    counts = ", ".join(f"CAST(len(list_filter(spans, lambda x: x.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}" for r in secrets.BASE)
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {', '.join(lists)} FROM d),"
        f" s AS (SELECT doc_id, list_sort({' || '.join(kinds)}) AS spans FROM m)"
        f" SELECT doc_id, {counts}, sha256(coalesce({join.format(base)}, '')) AS base_sha256,"
        f" coalesce({join.format('spans')}, '') AS spans FROM s"
    )


_MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|mix') AS h
  FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
i AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s),
w AS (SELECT *, CAST((i - 1) % 3 + 1 AS DOUBLE) AS w, source_size * 3 AS cap FROM i),
r AS (SELECT *, CAST(cap AS DOUBLE) / w AS ratio FROM w),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY ratio, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT ratio AS f_ratio, i AS f_i, level AS f_level FROM l WHERE ratio >= level ORDER BY ratio, i LIMIT 1),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN f_i IS NULL OR ratio < f_ratio OR (ratio = f_ratio AND i < f_i) THEN CAST(cap AS DOUBLE)
              ELSE w * f_level END AS target
  FROM l LEFT JOIN f ON true),
q AS (
  SELECT d.doc_id, d.source, d.size, d.h, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT q.*, pass, CAST(pass * source_size + upto AS DOUBLE) / target AS finish
  FROM q, range(0, 3) x(pass) WHERE size > 0 AND target > 0),
o AS (
  SELECT *, sum(size) OVER (ORDER BY finish, h, source NULLS FIRST, doc_id NULLS FIRST, size, pass
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ahead
  FROM p),
n AS (SELECT doc_id, source, size, count(*) AS passes FROM o
      WHERE ahead <= (SELECT sum(size) FROM d) GROUP BY doc_id, source, size)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(n.passes, 0) AS BIGINT) AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.source IS NOT DISTINCT FROM n.source AND q.size = n.size
"""

ORACLES = {
    "op4_secrets": _secrets_sql(),
    "op7_mixing": _MIXING_SQL,
    "op11_centroids": sql.clusters_sql(),
    "op12_setjoin": sql.set_join_sql(),
    "op13_merkle": sql.merkle_sql(),
}

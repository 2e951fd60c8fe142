"""SQL of the clustering, the set join and the manifest, for the driver's comparison with DuckDB."""

from __future__ import annotations


def merkle_sql() -> str:
    def leaf(n_chars: str) -> str:
        parts = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
        return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"

    crc = (
        "xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])), lambda a, x: xor(xor(a, x) >> 1,"
        " CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT)"
    )

    def tree(name: str, base: str) -> str:
        """Levels of nodes per group as lists, then nodes, from (g, l) with the list of a group's leaves."""
        up = "list_transform(range(0, len(l), 2), lambda i: sha256(l[i + 1] || coalesce(l[i + 2], '')))"
        return (
            f"{name}_levels AS (SELECT g, 0 AS level, l FROM {base} UNION ALL"
            f" SELECT g, level + 1, {up} FROM {name}_levels WHERE len(l) > 1),"
            f" {name} AS (SELECT g, level, len(l) AS size, unnest(range(0, len(l))) AS idx, unnest(l) AS h FROM {name}_levels),"
            f" {name}_top AS (SELECT g, arg_max(l[1], level) AS h, max(level) AS high FROM {name}_levels GROUP BY g)"
        )

    def walk(name: str, nodes: str, start: str) -> str:
        """Folded digest and proof of every row of ``start`` (doc_id, g, pos, cur, proof, high)."""
        return (
            f"{name} AS (SELECT doc_id, g, 0 AS level, pos, cur, proof, high FROM {start} UNION ALL"
            f" SELECT w.doc_id, w.g, w.level + 1, w.pos >> 1, sha256(CASE WHEN w.pos & 1 = 1 THEN coalesce(s.h, '') || w.cur"
            f" ELSE w.cur || coalesce(s.h, '') END), w.proof || coalesce(s.h, ''), w.high"
            f" FROM {name} w LEFT JOIN {nodes} s ON s.g = w.g AND s.level = w.level AND s.idx = xor(w.pos, 1) WHERE w.level < w.high)"
        )

    return (
        f"WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g, {leaf('n_chars')} AS leaf,"
        f" CASE WHEN ({crc}) % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS later FROM documents),"
        " p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST) - 1 AS pos FROM d),"
        " a AS (SELECT g, list(leaf ORDER BY pos) AS l FROM p GROUP BY g),"
        f" {tree('t', 'a')},"
        " b AS (SELECT '' AS g, list(h ORDER BY g) AS l FROM t_top),"
        f" {tree('u', 'b')},"
        " low_start AS (SELECT doc_id, g, pos, later AS cur, '' AS proof, high FROM p JOIN t_top USING (g)),"
        f" {walk('low', 't', 'low_start')},"
        " place AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS pos FROM t_top),"
        " high_start AS (SELECT low.doc_id, '' AS g, place.pos, cur, proof, (SELECT high FROM u_top) AS high FROM low JOIN place USING (g)"
        " WHERE low.level = low.high),"
        f" {walk('high_', 'u', 'high_start')}"
        " SELECT p.doc_id, p.leaf, t_top.h AS subroot, u_top.h AS root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root,"
        " w.cur = u_top.h AS verified FROM p JOIN t_top USING (g) JOIN high_ w ON w.doc_id = p.doc_id AND w.level = w.high"
        " CROSS JOIN u_top"
    )


def clusters_sql(k: int = 16, rounds: int = 3) -> str:
    near = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        "v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e"
        " FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, e FROM v ORDER BY sha256('1:' || vec_id) LIMIT {k})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT v.r, c.k, CAST({near} AS BIGINT) AS d FROM v CROSS JOIN c{i} c) GROUP BY r)"
        )
        if i < rounds:
            steps.append(
                f"m{i} AS (SELECT k, j, CAST(floor(sum(e[j]) / count(*)) AS BIGINT) AS x FROM (SELECT a.k, v.e, unnest(range(1, 65)) AS j FROM a{i} a JOIN v USING (r)) GROUP BY k, j)"
            )
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(n.e, c.e) AS e FROM c{i} c LEFT JOIN (SELECT k, list(x ORDER BY j) AS e FROM m{i} GROUP BY k) n USING (k))"
            )
    return (
        "WITH " + ", ".join(steps) + f" SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance,"
        " CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,"
        " sha256(array_to_string(list_transform(c.e, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256"
        f" FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.k = a.k"
    )


def set_join_sql(words: int = 4, percent: int = 85) -> str:
    return (
        r"WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),"
        f" s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]"
        f" ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS s FROM d),"
        " n AS (SELECT doc_id, len(s) AS n FROM s),"
        " c AS (SELECT min(doc_id) AS c, s, len(s) AS n, list(doc_id) AS ids FROM (SELECT doc_id, list_sort(s) AS s FROM s) GROUP BY s),"
        " g AS (SELECT c, n, unnest(list_transform(s, lambda x: hash(x))) AS x FROM c),"
        f" l AS (SELECT a.c AS u, b.c AS v FROM g a JOIN g b ON a.x = b.x AND a.c <> b.c AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n"
        f" GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),"
        " r AS (SELECT c AS u, c AS v FROM c UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v),"
        " m AS (SELECT u, min(v) AS v FROM r GROUP BY u),"
        " k AS (SELECT unnest(ids) AS doc_id, c, n FROM c)"
        " SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, CASE WHEN n.n = 0 THEN n.doc_id ELSE m.v END AS component_id"
        " FROM n JOIN k USING (doc_id) JOIN m ON m.u = k.c"
    )

"""The same results in plain SQL, for the operators whose whole result SQL can express."""

from __future__ import annotations

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_sql(shingle: int, percent: int, extra: str = "") -> str:
    """Components of documents whose sets of ``shingle``-word runs are similar enough."""
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(shingle))
    return rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")},
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT doc_id, s FROM (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {shingle}
            THEN list_transform(range(1, len(w) - {shingle - 2}), lambda i: {run})
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM words)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), content AS (
    SELECT doc_id, n, md5(string_agg(s, chr(10) ORDER BY s)) AS h
    FROM shingle JOIN size USING (doc_id) GROUP BY doc_id, n
), class AS (
    SELECT h, n, min(doc_id) AS rep FROM content GROUP BY h, n
), own AS (
    SELECT s, doc_id AS rep, n FROM shingle JOIN class ON doc_id = rep
), common AS (
    SELECT s FROM own GROUP BY s HAVING count(*) > 1
), pair AS (
    SELECT a.rep AS a, b.rep AS b
    FROM (SELECT * FROM own JOIN common USING (s)) a
    JOIN (SELECT * FROM own JOIN common USING (s)) b ON a.s = b.s AND a.rep < b.rep
        AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}
    GROUP BY a.rep, b.rep, a.n, b.n
    HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), link AS (
    SELECT a, b FROM pair UNION SELECT b, a FROM pair
), reach AS (
    SELECT rep AS a, rep AS b FROM class
    UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (
    SELECT a AS rep, min(b) AS component FROM reach GROUP BY a
), placed AS (
    SELECT c.doc_id, c.n, component FROM content c JOIN class USING (h, n)
    JOIN component USING (rep)
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id{extra}
FROM documents LEFT JOIN placed USING (doc_id)
"""


def _crc_table() -> str:
    step = "xor(a >> 1, 3988292384 * (a & 1))"
    return (f"list_transform(range(0, 256), lambda v: list_reduce(list_prepend(v, "
            f"[0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: {step}))")


def _crc32(hexed: str) -> str:
    """CRC-32 of bytes in hex; ``crc.t`` is the table."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform("
            f"range(0, length({hexed}) // 2), lambda i: CAST('0x' || substr({hexed}, "
            f"CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))), "
            f"lambda a, z: xor(a >> 8, t[1 + (xor(a, z) & 255)])))")


def merkle_sql(levels: int = 8, top_levels: int = 3) -> str:
    """Leaves, roots and proofs of trees of up to 8 ** levels leaves and 8 ** top_levels trees."""
    def part(value: str) -> str:
        return (f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), "
                "'-')")

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in (
            "doc_id", "source", "lang", "n_chars", text)) + ")"

    parts = [f"""
WITH crc AS (SELECT {_crc_table()} AS t),
leaf AS (
    SELECT doc_id, lang, {leaf("text")} AS d,
        CASE WHEN {_crc32("hex(CAST(doc_id AS VARCHAR))")} % 3 = 0
            THEN {leaf(_FOLD.format("text"))} END AS other
    FROM documents, crc
), p0 AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
        '' AS proof, coalesce(other, d) AS folded
    FROM leaf
), n0 AS (SELECT lang, i, d, count(*) OVER (PARTITION BY lang) AS n FROM p0)"""]

    def climb(k: int, tree: str, on: str, nodes: str, path: str) -> str:
        """One level: the runs of n<k> become n<k + 1>, the paths p<k> become p<k + 1>."""
        over = f"OVER (PARTITION BY {tree}i // 8 ORDER BY i ROWS BETWEEN "
        group = f"{tree}i // 8, n"
        return f""", {nodes}{k}s AS (
    SELECT *, coalesce(string_agg(d, '') {over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(d, '') {over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {nodes}{k} WHERE n > 1
), {path}{k + 1} AS (
    SELECT p.* EXCLUDE (i, proof, folded), p.i // 8 AS i, proof || coalesce(l || r, '') AS proof,
        CASE WHEN s.n IS NULL THEN folded ELSE sha256(l || folded || r) END AS folded
    FROM {path}{k} p LEFT JOIN {nodes}{k}s s ON {on} AND p.i = s.i
), {nodes}{k + 1} AS (
    SELECT {tree}i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY i))
        ELSE min(d) END AS d, (n + 7) // 8 AS n
    FROM {nodes}{k} GROUP BY {group}
)"""

    for k in range(levels):
        parts.append(climb(k, "lang, ", "p.lang IS NOT DISTINCT FROM s.lang", "n", "p"))
    parts.append(f""", m0 AS (
    SELECT row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, lang, d, count(*) OVER () AS n
    FROM n{levels}
), q0 AS (
    SELECT p.* EXCLUDE (i), m.i, m.d AS subroot
    FROM p{levels} p JOIN m0 m ON p.lang IS NOT DISTINCT FROM m.lang
)""")
    for k in range(top_levels):
        parts.append(climb(k, "", "true", "m", "q"))
    parts.append(f"""
SELECT doc_id, q.d AS leaf, subroot, m.d AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = m.d AS verified
FROM q{top_levels} q, m{top_levels} m
""")
    return "".join(parts)


RESAMPLING_SQL = rf"""
WITH crc AS (SELECT {_crc_table()} AS t),
words AS (
    SELECT true AS ours, doc_id, text FROM documents
    UNION ALL SELECT false, NULL, text FROM benchmark
), feature AS (
    SELECT ours, doc_id, unnest(regexp_extract_all({_FOLD.format("coalesce(text, '')")},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM words
), bucket AS (
    SELECT w, {_crc32("hex(w)")} % 10000 AS b FROM (SELECT DISTINCT w FROM feature), crc
), total AS (
    SELECT b, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t
    FROM feature JOIN bucket USING (w) GROUP BY b
), every AS (
    SELECT CAST(sum(s) AS BIGINT) AS s_all, CAST(sum(t) AS BIGINT) AS t_all FROM total
), gain AS (
    SELECT b, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS g
    FROM total, every
), weight AS (
    SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS weight
    FROM feature JOIN bucket USING (w) JOIN gain USING (b) WHERE ours GROUP BY doc_id
), scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(
            sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
            / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM documents LEFT JOIN weight USING (doc_id)
), placed AS (
    SELECT *, CASE WHEN n_features >= 20 THEN
        row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
        count(*) FILTER (n_features >= 20) OVER () AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM placed
"""

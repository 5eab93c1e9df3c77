"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n
"""

# the escapes of operators/chat: backslash first, then the control strings
_ESC = r"replace(replace(replace({0}, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"
_ESC_ROLE = r"replace(" + _ESC.format("r") + r", ':', '\:')"

OP2 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
       CAST(sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS FIRST, r, t))
         AS loss_sha256,
       CAST(sum(length({_ESC_ROLE}) + length({_ESC.format("t")}) + 14) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
 g AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
       FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
 r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g),
 p AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM r WHERE n > 1)
       GROUP BY rid),
 l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
 m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
              CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
              CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
              CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
              CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
       FROM d JOIN l USING (rid) LEFT JOIN p USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 4 * n_symbols > n_words
            OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines) OR 2 * word_chars < 3 * n_words OR word_chars > 25 * n_words) AS kept
FROM m
""".replace("\\\\", "\\")

OP6 = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS u
           FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 w AS (SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
              [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS w
       FROM s),
 lv AS (SELECT *, cap / w AS full_at,
               (sum(source_size) OVER () * 1.5::DOUBLE
                - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, encode(source)
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source IS NULL, encode(source)
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
        FROM w),
 t AS (SELECT source, source_size,
              least(cap, coalesce((SELECT min_by(level, full_at) FROM lv WHERE level <= full_at) * w, cap)) AS target
       FROM lv),
 b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM t),
 n AS (SELECT *, target - base * source_size AS need FROM b),
 c AS (SELECT d.*, n.source_size, n.target, n.base, n.need,
              sum(size) OVER (PARTITION BY d.source ORDER BY u) AS upto,
              sum(size) OVER (PARTITION BY d.source, u) AS here
       FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (base + CASE WHEN need > 0 AND (upto <= need
                                     OR (upto - here <= need AND here < 2 * (need - (upto - here))))
                                THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                           ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)])
                      END AS s FROM d),
 e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
 f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
 p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i
       FROM (SELECT * FROM e WHERE g IN (SELECT g FROM f)) a JOIN e b
         ON a.g = b.g AND a.doc_id < b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY 1, 2),
 l AS (SELECT x, y FROM p WHERE 100 * i >= 90 * (nx + ny - i)),
 u AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 r AS (SELECT x, y FROM u UNION SELECT r.x, u.y FROM r JOIN u ON r.y = u.x),
 c AS (SELECT x, min(y) AS c FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(c, s.doc_id)) AS component_id
FROM s LEFT JOIN c ON s.doc_id = c.x
"""

_TERM = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_P13 = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({all_n} + 2 * {v})"

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, {_TERM}) AS w FROM documents),
 gr AS (SELECT DISTINCT lang, source FROM d),
 e AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
 k AS (SELECT lang, term FROM e GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
 v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM gr) g LEFT JOIN k USING (lang) GROUP BY g.lang),
 n AS (SELECT lang, source, term, count(*) AS n FROM e JOIN k USING (lang, term) GROUP BY lang, source, term),
 a AS (SELECT gr.lang, gr.source, coalesce(any_value(v.v), 0) AS v, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS all_n
       FROM gr JOIN v USING (lang) LEFT JOIN n USING (lang, source) GROUP BY gr.lang, gr.source),
 p AS (SELECT a.lang, a.source, k.term, coalesce(n.n, 0) AS n,
              {_P13.format(n="coalesce(n.n, 0)", all_n="a.all_n", v="a.v")} AS p
       FROM a JOIN k USING (lang) LEFT JOIN n ON n.lang = a.lang AND n.source = a.source AND n.term = k.term),
 q AS (SELECT n.lang, n.term, {_P13.format(n="sum(n.n)", all_n="any_value(l.all_n)", v="any_value(l.v)")} AS q
       FROM n JOIN (SELECT lang, sum(all_n) AS all_n, any_value(v) AS v FROM a GROUP BY lang) l USING (lang)
       GROUP BY n.lang, n.term),
 s AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
       FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
 r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
       FROM gr x JOIN gr y ON x.lang = y.lang AND x.source <> y.source
       LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
       UNION ALL
       SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS BIGINT)
       FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
 t AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
       FROM r)
SELECT * FROM t WHERE part = 'pair' OR rank <= 10
"""


def _op11(rounds: int = 3, k: int = 16, dims: int = 64) -> str:
    near = """ n{r} AS (SELECT rid, min(d) AS d, arg_min(cluster, (d, cluster)) AS cluster
        FROM (SELECT v.rid, c.cluster, list_sum(list_transform(list_zip(v.xs, c.xs),
                     lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{r} c) GROUP BY rid)"""
    step = """ m{r} AS (SELECT cluster, list(m ORDER BY j) AS xs
        FROM (SELECT cluster, j, (s - ((s % n) + n) % n) // n AS m
              FROM (SELECT cluster, j, sum(x)::HUGEINT AS s, count(*) AS n
                    FROM (SELECT n.cluster, unnest(v.xs) AS x, unnest(range({dims})) AS j
                          FROM v JOIN n{r} n USING (rid)) GROUP BY cluster, j)) GROUP BY cluster),
 c{next} AS (SELECT cluster, CAST(coalesce(m.xs, c.xs) AS BIGINT[]) AS xs FROM c{r} c LEFT JOIN m{r} m USING (cluster))"""
    parts = []
    for r in range(rounds):
        parts += [near.format(r=r), step.format(r=r, next=r + 1, dims=dims)]
    parts.append(near.format(r=rounds))
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
                  list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS xs
           FROM embeddings
           WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
 c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), xs) - 1 AS cluster, xs
        FROM v QUALIFY cluster < {k}),
{",".join(parts)},
 i AS (SELECT cluster, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM n{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia,
       CAST((SELECT sum(d) FROM n{rounds}) AS BIGINT) AS inertia, sha256(array_to_string(c.xs, ',')) AS centroid_sha256
FROM n{rounds} JOIN v USING (rid) JOIN i USING (cluster) JOIN c{rounds} c USING (cluster)
"""


OP11 = _op11()

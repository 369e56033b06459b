"""Comparison SQL (DuckDB) for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
k AS MATERIALIZED (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT r.node, k.b FROM r JOIN k ON k.a = r.reached)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY 1) m ON m.node = d.doc_id"""

OP12 = """
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n, sha256('1:' || doc_id) AS x FROM documents),
h AS (SELECT *, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, i) AS head, substr(t, i + 1, j - i) AS middle, substr(t, j + 1) AS tail FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
              ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""

OP13 = f"""
WITH crc AS (SELECT list(c ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS c FROM range(256) t(i))),
both_sides AS (SELECT 0 AS side, doc_id, {_WORDS} AS w FROM documents UNION ALL SELECT 1, NULL, {_WORDS} FROM benchmark),
f AS (SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM both_sides),
coded AS (SELECT feature, list_transform(range(1, len(hex(feature)), 2), lambda k: (instr('0123456789ABCDEF', hex(feature)[k]) - 1) * 16 + instr('0123456789ABCDEF', hex(feature)[k + 1]) - 1) AS bytes
          FROM (SELECT DISTINCT feature FROM f)),
b AS (SELECT feature, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, entries[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM coded, crc),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (feature) GROUP BY 1),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(n.t + 1 AS DOUBLE) * CAST(total.s + 10000 AS DOUBLE) / (CAST(n.s + 1 AS DOUBLE) * CAST(total.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM n, total),
own AS (SELECT doc_id, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 0 GROUP BY 1),
scored AS (SELECT d.doc_id, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0) AS weight,
        COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM documents d LEFT JOIN own USING (doc_id)),
ranked AS (SELECT *, CASE WHEN n_features >= 39 THEN row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_features >= 39) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM ranked"""

ORACLES = {"op8_ngram_jaccard": OP8, "op12_fill_in_middle": OP12, "op13_importance_resampling": OP13}

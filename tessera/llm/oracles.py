"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BM25 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d),
t AS (SELECT r, doc_id, dl, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(w) AS dl, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (SELECT term, ln(1 + (g.n - df + 0.5) / (df + 0.5)) AS idf FROM f, g),
q AS (SELECT DISTINCT doc_id AS query_id, term, idf FROM t JOIN i USING (term) WHERE doc_id % 100 = 0),
s AS (SELECT query_id, r, t.doc_id, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))) AS score
      FROM q JOIN t USING (term), g GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER w <= 10
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                  row_number() OVER w AS k, first_value(page_id) OVER w AS lead_id
           FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, coalesce(url, ''))),
b AS (SELECT *, [CAST('0x' || substr(h, 1 + 5 * i, 5) AS BIGINT) for i in range(8)] AS n FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((x >> 15) & 31 AS INTEGER), 1)
                     || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((x >> 10) & 31 AS INTEGER), 1)
                     || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((x >> 5) & 31 AS INTEGER), 1)
                     || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(x & 31 AS INTEGER), 1) for x in n], '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN lead_id END AS refers_to
FROM b
"""

CROSS_ENTROPY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_concat([' s'], regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), [' e']) AS w FROM documents),
c AS (SELECT row_number() OVER () AS r, list_concat([' s'], regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), [' e']) AS w FROM conversations),
de AS (SELECT r, doc_id, w[i] AS v, w[i + 1] AS x FROM (SELECT r, doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
ce AS (SELECT w[i] AS v, w[i + 1] AS x FROM (SELECT w, unnest(range(1, len(w))) AS i FROM c)),
n AS (SELECT (SELECT count(*) FROM de) AS nb, (SELECT count(*) FROM ce) AS nt),
bw AS (SELECT x, count(*) AS b FROM de GROUP BY x), tw AS (SELECT x, count(*) AS t FROM ce GROUP BY x),
bp AS (SELECT v, x, count(*) AS b FROM de GROUP BY ALL), tp AS (SELECT v, x, count(*) AS t FROM ce GROUP BY ALL),
wd AS (SELECT x, b, coalesce(t, 0) AS t FROM bw LEFT JOIN tw USING (x)),
m AS (SELECT bp.v, bp.x, bp.b AS pb, coalesce(tp.t, 0) AS pt, h.b AS hb, h.t AS ht, wd.b / nb AS ub,
             (wd.t + 1000.0 * wd.b / nb) / (nt + 1000.0) AS ut
      FROM bp LEFT JOIN tp USING (v, x) JOIN wd ON wd.x = bp.x JOIN wd h ON h.x = CASE WHEN bp.v = ' s' THEN ' e' ELSE bp.v END, n),
e AS (SELECT r, doc_id, -ln((pb + 2.0 * ub) / (hb + 2.0)) AS lb, -ln((pt + 2.0 * ut) / (ht + 2.0)) AS lt FROM de JOIN m USING (v, x))
SELECT doc_id, count(*) AS n_events, round(avg(lt), 6) AS h_target, round(avg(lb), 6) AS h_background,
       round(avg(lt) - avg(lb), 6) AS score
FROM e GROUP BY r, doc_id
"""

FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, [CAST('0x' || substr(x, 1 + 8 * i, 8) AS BIGINT) for i in range(4)] AS h FROM d),
c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLES = {"op3_bm25_search": BM25, "op5_warc": WARC, "op6_cross_entropy": CROSS_ENTROPY, "op11_fill_in_middle": FILL_IN_MIDDLE}

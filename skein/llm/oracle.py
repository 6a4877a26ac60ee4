"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS data FROM pages),
d AS (SELECT page_id, octet_length(data) AS payload_bytes, sha1(data) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT d.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(d.h, CAST(1 + 10 * (i // 8) AS INT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) AS INT), 1)), '') AS payload_digest,
       CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM d JOIN f ON d.h = f.h
"""

# Windows of every length that occurs among the items are looked up in the documents.
_OP8 = f"""
WITH iw AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, list_slice(w, i, i + least(len(w), 13) - 1) AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
spot AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes)),
hit AS (SELECT spot.doc_id, spot.i, spot.k, win.item_id FROM spot JOIN win ON spot.g = win.g),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
p AS (SELECT *, array_to_string(list_slice(u, 1, least(c1, c2)), '') AS prefix,
             array_to_string(list_slice(u, least(c1, c2) + 1, greatest(c1, c2)), '') AS middle, array_to_string(list_slice(u, greatest(c1, c2) + 1, n), '') AS suffix,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLE: dict[str, str] = {"op5_warc_bundles": _OP5, "op8_aho_corasick": _OP8, "op13_counted_fill": _OP13}

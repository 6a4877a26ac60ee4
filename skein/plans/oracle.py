"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently of the Spark code, straight from the
(documents, labels, embeddings, conversations, ...). Shared steps are CTEs;
``build(final, *ctes)`` pulls in the needed CTEs in dependency order.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
_ORDER: list[str] = []


def cte(name: str, body: str) -> None:
    CTES[name] = body
    _ORDER.append(name)


def _deps(name: str, seen: set) -> None:
    if name in seen:
        return
    body = CTES[name]
    for other in _ORDER:
        if other != name and re.search(r"\b" + re.escape(other) + r"\b", body):
            _deps(other, seen)
    seen.add(name)


def build(final: str) -> str:
    seen: set = set()
    for name in _ORDER:
        if re.search(r"\b" + re.escape(name) + r"\b", final):
            _deps(name, seen)
    used = [n for n in _ORDER if n in seen]
    if not used:
        return final
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in used) + "\n" + final


# Optimal string alignment distance by characters: rows of the table, two of them carried.
def osa(a: str, b: str) -> str:
    return f"""list_reduce(
  range(1, length({a}) + 1),
  lambda st, i: [st[2], list_reduce(
      range(1, length({b}) + 1),
      lambda acc, j: list_append(acc, least(st[2][j + 1] + 1, acc[-1] + 1,
                      st[2][j] + CASE WHEN substr({a}, i, 1) = substr({b}, j, 1) THEN 0 ELSE 1 END,
                      CASE WHEN i > 1 AND j > 1 AND substr({a}, i, 1) = substr({b}, j - 1, 1) AND substr({a}, i - 1, 1) = substr({b}, j, 1)
                           THEN st[1][j - 1] + 1 ELSE 1000000 END)),
      [i])],
  [range(0, length({b}) + 1), range(0, length({b}) + 1)])[2][-1]"""


TERMS_RE = r"'[\p{L}\p{N}]+'"
SENT_RE = r"'[^.!?\n]+[.!?]*'".replace(r"\n", "\n")
NL = "chr(10)"

# ------------------------------------------------------------------ graph (G)
cte("named", """
SELECT doc_id, text, lang, source, 'doc' || CAST(doc_id AS VARCHAR) AS node_id,
       'doc' || CAST(CASE WHEN doc_id % 31 = 0 AND doc_id > 60 THEN doc_id - 60 ELSE doc_id END AS VARCHAR) AS name
FROM documents""")
cte("nodes", """
SELECT node_id, name,
       CASE doc_id % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'organization' WHEN 2 THEN 'event' END AS labeled,
       text AS description,
       CASE WHEN doc_id % 3 = 0 THEN source || ', ' || lang END AS metadata
FROM named
UNION ALL
SELECT 'src:' || source, source, 'place', source || ' ' || string_agg(DISTINCT lang, ' ' ORDER BY lang),
       CAST(NULL AS VARCHAR)
FROM documents GROUP BY source
UNION ALL
SELECT 'item' || CAST(item_id AS VARCHAR), 'item' || CAST(item_id AS VARCHAR), 'event', text, CAST(NULL AS VARCHAR)
FROM benchmark""")
cte("gkept", "SELECT * FROM named")
cte("gseq", """
SELECT *, lead(node_id) OVER (PARTITION BY source ORDER BY doc_id) AS next_node FROM gkept""")
cte("edges", """
SELECT 'pub:' || CAST(doc_id AS VARCHAR) AS edge_id, node_id AS src_id, 'src:' || source AS dst_id,
       'published_in' AS rel_type, name || ' published in ' || source AS description FROM gkept
UNION ALL
SELECT 'fol:' || CAST(doc_id AS VARCHAR), node_id, next_node, 'follows', text
FROM gseq WHERE next_node IS NOT NULL
UNION ALL
SELECT 'cit:' || CAST(doc_id AS VARCHAR), node_id, 'src:' || source, 'cites', name || ' cites ' || source
FROM gkept WHERE doc_id % 10 = 0
UNION ALL
SELECT 'men:' || CAST(doc_id AS VARCHAR), node_id, node_id, 'mentions', 'self note ' || CAST(doc_id AS VARCHAR)
FROM gkept WHERE doc_id % 97 = 0""")
cte("prompts", """
SELECT CAST(prompt_id AS BIGINT) AS prompt_id, prompt FROM (VALUES (1, 'with by ionreat'), (2, 'doc12'), (3, 'src6'), (4, 'src13'),
  (5, 'the eringing'), (6, 'les eauxmentre'), (7, 'und enstöung'), (8, 'self notes'),
  (9, 'doc30'), (10, 'zzzzqqq')) t(prompt_id, prompt)
UNION ALL SELECT item_id + 1000, text FROM benchmark""")

# ------------------------------------------------------------ full text (B)
cte("items", """
SELECT 'node' AS kind, node_id AS item_id, concat_ws(' ', name, description) AS text FROM nodes
UNION ALL SELECT 'edge', edge_id, description FROM edges""")
cte("occ", f"""
SELECT kind, item_id, len(t) AS dl, unnest(t) AS term
FROM (SELECT kind, item_id, regexp_extract_all(lower(text), {TERMS_RE}) AS t FROM items)""")
cte("postings", """
SELECT kind, item_id, term, count(*) AS tf, any_value(dl) AS dl FROM occ GROUP BY kind, item_id, term""")
cte("vocab", "SELECT kind, term, count(*) AS df FROM postings GROUP BY kind, term")
cte("corpus", """
SELECT kind, count(*) AS n_items, avg(dl) AS avgdl
FROM (SELECT DISTINCT kind, item_id, dl FROM postings) GROUP BY kind""")
cte("qterms", f"""
SELECT prompt_id, CAST(i - 1 AS INTEGER) AS pos, t[i] AS term, i = len(t) AS is_fuzzy
FROM (SELECT prompt_id, t, unnest(generate_series(1, len(t))) AS i
      FROM (SELECT prompt_id, regexp_extract_all(lower(prompt), {TERMS_RE}) AS t FROM prompts))""")
# Unrestricted Damerau-Levenshtein (built in, counts bytes) is never above the wanted distance.
cte("fz_cand", f"""
SELECT q.prompt_id, v.kind, q.pos, q.term AS query_term, v.term,
       CASE WHEN strlen(v.term) = length(v.term) AND strlen(q.term) = length(q.term) AND damerau_levenshtein(v.term, q.term) > 2
            THEN 9 ELSE {osa('v.term', 'q.term')} END AS distance
FROM qterms q JOIN vocab v ON abs(length(v.term) - length(q.term)) <= 2
WHERE q.is_fuzzy""")
cte("fuzzy", """
SELECT prompt_id, kind, pos, query_term, term, distance, weight FROM (
  SELECT *, row_number() OVER (PARTITION BY prompt_id, kind, pos ORDER BY weight DESC, term) AS rn
  FROM (SELECT *, 1.0::DOUBLE - CAST(distance AS DOUBLE) / least(length(term), length(query_term)) AS weight
        FROM fz_cand WHERE distance <= 2 AND distance < least(length(term), length(query_term))))
WHERE rn <= 50""")
cte("expanded", """
SELECT prompt_id, k.kind, pos, term AS query_term, term, 0 AS distance, 1.0::DOUBLE AS weight
FROM qterms, (VALUES ('node'), ('edge')) k(kind) WHERE NOT is_fuzzy
UNION ALL SELECT prompt_id, kind, pos, query_term, term, distance, weight FROM fuzzy""")
cte("hits", """
SELECT e.prompt_id, e.kind, p.item_id,
       round(sum(e.weight * ln(1.0::DOUBLE + (c.n_items - v.df + 0.5::DOUBLE) / (v.df + 0.5::DOUBLE))
                 * p.tf / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * p.dl / c.avgdl))), 9) AS score
FROM expanded e JOIN vocab v ON v.kind = e.kind AND v.term = e.term
JOIN postings p ON p.kind = e.kind AND p.term = e.term
JOIN corpus c ON c.kind = e.kind
GROUP BY e.prompt_id, e.kind, p.item_id""")
cte("top40", """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY prompt_id, kind ORDER BY score DESC, item_id) AS INTEGER) AS rank
               FROM hits) WHERE rank <= 40""")
cte("stats", """
SELECT *, round(max_score - 1.0::DOUBLE * std_score, 9) AS threshold FROM (
  SELECT *, max(score) OVER w AS max_score, avg(score) OVER w AS avg_score, stddev_pop(score) OVER w AS std_score
  FROM top40 WINDOW w AS (PARTITION BY prompt_id, kind))""")
cte("cut", "SELECT *, score / max_score AS relative_score FROM stats WHERE score >= threshold")

# ------------------------------------------------------------------ graph
cte("adj", """
SELECT src_id AS node_id, edge_id, dst_id AS other_id, rel_type, description FROM edges
UNION ALL SELECT dst_id, edge_id, src_id, rel_type, description FROM edges WHERE src_id <> dst_id""")
cte("node_rows", """
SELECT h.prompt_id, h.item_id, h.score, a.edge_id, a.other_id AS neighbor_id, a.rel_type,
       a.description AS rel_description
FROM cut h JOIN adj a ON h.item_id = a.node_id WHERE h.kind = 'node'""")
cte("ehits", """
SELECT h.prompt_id, h.item_id, h.score, e.src_id, e.dst_id, e.description AS hit_description
FROM cut h JOIN edges e ON h.item_id = e.edge_id WHERE h.kind = 'edge'""")
cte("endpoints", """
SELECT prompt_id, item_id, score, src_id, dst_id, hit_description, src_id AS endpoint_id FROM ehits
UNION SELECT prompt_id, item_id, score, src_id, dst_id, hit_description, dst_id FROM ehits""")
cte("expansion", """
SELECT ep.*, nb.nb_edge_id, nb.neighbor_id, nb.nb_description
FROM (SELECT e.*, n.labeled AS endpoint_labeled FROM endpoints e LEFT JOIN nodes n ON n.node_id = e.endpoint_id) ep
LEFT JOIN (SELECT a.node_id AS nb_node, a.edge_id AS nb_edge_id, a.other_id AS neighbor_id,
                  n.labeled AS neighbor_labeled, a.description AS nb_description
           FROM adj a LEFT JOIN nodes n ON n.node_id = a.other_id) nb
  ON ep.endpoint_id = nb.nb_node
 AND ep.endpoint_labeled <> 'event' AND ep.endpoint_labeled <> 'organization'
 AND nb.neighbor_labeled <> 'event' AND nb.neighbor_labeled <> 'organization'
 AND nb.neighbor_id <> ep.src_id AND nb.neighbor_id <> ep.dst_id""")
cte("occn", """
SELECT o.*, coalesce(n.name, '') AS name, coalesce(n.labeled, '') AS labeled,
       coalesce(n.description, '') AS description, coalesce(n.metadata, '') AS metadata
FROM (SELECT * FROM (SELECT DISTINCT prompt_id, item_id AS node_id, 1 AS phase, score, item_id, 0 AS role FROM node_rows)
      UNION ALL SELECT prompt_id, neighbor_id, 1, score, item_id, 1 FROM node_rows
      UNION ALL SELECT prompt_id, src_id, 2, score, item_id, 0 FROM endpoints
      UNION ALL SELECT prompt_id, dst_id, 2, score, item_id, 1 FROM endpoints
      UNION ALL SELECT prompt_id, neighbor_id, 2, score, item_id, 2 FROM expansion WHERE neighbor_id IS NOT NULL) o
JOIN nodes n ON n.node_id = o.node_id""")
cte("ctx_nodes", "SELECT DISTINCT prompt_id, name, labeled, description FROM occn")
cte("ctx_rels", """
SELECT DISTINCT prompt_id, description FROM (
  SELECT prompt_id, rel_description AS description FROM node_rows
  UNION ALL SELECT prompt_id, hit_description FROM endpoints
  UNION ALL SELECT prompt_id, nb_description FROM expansion)
WHERE coalesce(description, '') <> ''""")
cte("meta_last", """
SELECT prompt_id, name, metadata FROM (
  SELECT *, row_number() OVER (PARTITION BY prompt_id, name
                               ORDER BY phase DESC, score ASC, item_id DESC, role DESC, node_id DESC) AS rn
  FROM occn WHERE metadata <> '') WHERE rn = 1""")
cte("meta_distinct", """
SELECT DISTINCT prompt_id, translate(metadata, ', ', '') AS metadata FROM meta_last
WHERE translate(metadata, ', ', '') <> ''""")
cte("ctx_blocks", f"""
SELECT coalesce(a.prompt_id, b.prompt_id) AS prompt_id, a.node_block, b.rel_block FROM
 (SELECT prompt_id, string_agg(line || {NL} || '-----', {NL} ORDER BY line) AS node_block FROM
   (SELECT prompt_id, name || ': is a ' || labeled || ' of description: ' || description AS line
    FROM ctx_nodes WHERE name <> '' AND labeled <> '') GROUP BY prompt_id) a
 FULL OUTER JOIN
 (SELECT prompt_id, string_agg(description || {NL} || '-----', {NL} ORDER BY description) AS rel_block
  FROM ctx_rels GROUP BY prompt_id) b ON a.prompt_id = b.prompt_id""")

GRAPH_CONTEXT = f"concat_ws({NL}, '*** Nodes:', node_block, {NL}, '*** Relationships', rel_block)"

ORACLE: dict[str, str] = {}


def q(key: str, final: str) -> None:
    ORACLE[key] = build(final)


q("graph_nodes", "SELECT * FROM nodes")
q("graph_edges", "SELECT * FROM edges")
q("ft_postings", "SELECT kind, item_id, term, tf, dl FROM postings")
q("ft_query_terms", f"""
SELECT prompt_id, CAST(i - 1 AS INTEGER) AS pos, t[i] AS term, i = len(t) AS is_fuzzy
FROM (SELECT prompt_id, t, unnest(generate_series(1, len(t))) AS i
      FROM (SELECT prompt_id, regexp_extract_all(lower(prompt), {TERMS_RE}) AS t FROM
            (SELECT prompt_id, prompt FROM prompts UNION ALL
             SELECT conv_id + 1000000000, arg_min(text, turn) FROM conversations WHERE role = 'user' GROUP BY conv_id)))""")
q("ft_fuzzy_expand", """SELECT prompt_id, kind, query_term, term, CAST(distance AS INTEGER) AS distance,
                                round(weight, 6) AS weight FROM fuzzy""")
q("ft_search_nodes", "SELECT prompt_id, item_id, score FROM hits WHERE kind = 'node'")
q("ft_search_edges", "SELECT prompt_id, item_id, score FROM hits WHERE kind = 'edge'")
q("ft_top40", "SELECT prompt_id, kind, item_id, score, rank FROM top40")
q("score_stats", """SELECT prompt_id, kind, count(*) AS n_top, max(score) AS max_score,
                           round(avg(score), 6) AS avg_score, round(stddev_pop(score), 6) AS std_score
                    FROM top40 GROUP BY prompt_id, kind""")
q("score_cluster_cut", """SELECT prompt_id, kind, item_id, score,
                                 threshold FROM cut""")
q("relative_score", """SELECT prompt_id, kind, item_id, round(relative_score, 6) AS relative_score,
                              max_score, threshold FROM cut""")
q("neighbors_inner", "SELECT prompt_id, item_id, edge_id, neighbor_id, rel_type FROM node_rows")
q("node_connections", """SELECT r.prompt_id, r.item_id, r.edge_id, r.neighbor_id, coalesce(n.name, '') AS neighbor_name, r.rel_type,
    coalesce(r.rel_description, '') AS description, coalesce(n.metadata, '') AS neighbor_metadata
    FROM node_rows r LEFT JOIN nodes n ON n.node_id = r.neighbor_id""")
q("edge_endpoints", """SELECT h.prompt_id, h.item_id AS edge_id, h.src_id, h.dst_id,
    s.name AS start_name, t.name AS end_name, s.metadata AS start_metadata, t.metadata AS end_metadata
    FROM ehits h LEFT JOIN nodes s ON s.node_id = h.src_id LEFT JOIN nodes t ON t.node_id = h.dst_id""")
q("edge_endpoint_set", "SELECT prompt_id, item_id AS edge_id, endpoint_id FROM endpoints")
q("neighbors_optional", """SELECT prompt_id, item_id AS edge_id, endpoint_id, nb_edge_id, neighbor_id
                           FROM expansion""")
q("edge_expansion", """SELECT x.prompt_id, x.item_id AS edge_id, x.endpoint_id, x.nb_edge_id, e.rel_type AS nb_type,
    CASE WHEN e.edge_id IS NOT NULL THEN coalesce(e.description, '') END AS nb_description, x.neighbor_id,
    CASE WHEN n.node_id IS NOT NULL THEN coalesce(n.name, '') END AS neighbor_name,
    CASE WHEN n.node_id IS NOT NULL THEN coalesce(n.labeled, '') END AS neighbor_labeled,
    CASE WHEN n.node_id IS NOT NULL THEN coalesce(n.metadata, '') END AS neighbor_metadata
    FROM expansion x LEFT JOIN edges e ON e.edge_id = x.nb_edge_id LEFT JOIN nodes n ON n.node_id = x.neighbor_id""")
q("search_ordered", """
SELECT r.prompt_id, r.kind, r.item_id, r.score, round(c.relative_score, 6) AS relative_score,
       CAST(row_number() OVER (PARTITION BY r.prompt_id, r.kind ORDER BY r.score DESC, r.item_id) AS INTEGER) AS rank
FROM (SELECT DISTINCT prompt_id, 'node' AS kind, item_id, score FROM node_rows
      UNION SELECT DISTINCT prompt_id, 'edge', item_id, score FROM endpoints) r
JOIN cut c ON c.prompt_id = r.prompt_id AND c.kind = r.kind AND c.item_id = r.item_id""")
q("node_defaults", """SELECT node_id, coalesce(name, '') AS name, coalesce(labeled, '') AS labeled,
    coalesce(description, '') AS description, coalesce(metadata, '') AS metadata FROM nodes""")
q("context_nodes", "SELECT * FROM ctx_nodes")
q("context_relations", "SELECT * FROM ctx_rels")
q("metadata_last_wins", "SELECT * FROM meta_last")
q("metadata_distinct", "SELECT * FROM meta_distinct")
q("graph_context", """
SELECT prompt_id, section, row_number() OVER (PARTITION BY prompt_id, section ORDER BY line) - 1 AS position, line FROM (
  SELECT prompt_id, 'nodes' AS section, name || ': is a ' || labeled || ' of description: ' || description AS line
  FROM ctx_nodes WHERE name <> '' AND labeled <> ''
  UNION ALL SELECT prompt_id, 'relationships', description FROM ctx_rels)""")
q("graph_retrieve", f"""
SELECT p.prompt_id, {GRAPH_CONTEXT} AS context, coalesce(m.metadata, '') AS metadata
FROM prompts p LEFT JOIN ctx_blocks b ON b.prompt_id = p.prompt_id
LEFT JOIN (SELECT prompt_id, string_agg(metadata, ',' ORDER BY metadata) AS metadata
           FROM meta_distinct GROUP BY prompt_id) m ON m.prompt_id = p.prompt_id""")

# ------------------------------------------------------------------ vectors (V)
cte("coll", """
SELECT d.doc_id AS pk, d.text, d.source || '/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR) AS path,
       d.source || ' ' || d.lang || ' document ' || CAST(d.doc_id AS VARCHAR) AS context,
       d.source || ', ' || d.lang AS metadata, e.embedding AS dense_vector
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id""")
cte("vtf", f"""
SELECT id, term, count(*) AS tf FROM (
  SELECT pk AS id, unnest(regexp_extract_all(lower(text), {TERMS_RE})) AS term FROM coll)
GROUP BY id, term""")
cte("vidf", """
SELECT term, ln((1.0::DOUBLE + (SELECT count(DISTINCT id) FROM vtf)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
FROM vtf GROUP BY term""")
cte("svec", """
SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS w
FROM (SELECT t.id, t.term, t.tf * i.idf AS raw FROM vtf t JOIN vidf i ON i.term = t.term)""")
cte("vq", """
SELECT pk AS query_id, dense_vector FROM coll WHERE pk % 100 = 0 AND dense_vector IS NOT NULL""")
cte("dense_hits", """
SELECT * FROM (
  SELECT query_id, pk, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS INTEGER) AS rank
  FROM (SELECT q.query_id, c.pk,
               round(list_inner_product(CAST(q.dense_vector AS DOUBLE[]), CAST(c.dense_vector AS DOUBLE[])), 9) AS score
        FROM vq q JOIN coll c ON c.pk <> q.query_id WHERE c.dense_vector IS NOT NULL))
WHERE rank <= 4""")
cte("sparse_hits", """
SELECT * FROM (
  SELECT query_id, pk, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS INTEGER) AS rank
  FROM (SELECT q.id AS query_id, d.id AS pk, round(sum(q.w * d.w), 9) AS score
        FROM svec q JOIN svec d ON q.term = d.term
        WHERE q.id IN (SELECT query_id FROM vq) AND q.id <> d.id GROUP BY q.id, d.id))
WHERE rank <= 4""")
cte("fused", """
SELECT coalesce(s.query_id, d.query_id) AS query_id, coalesce(s.pk, d.pk) AS pk,
       s.score AS sparse_score, d.score AS dense_score,
       round(0.7::DOUBLE * coalesce(0.5::DOUBLE + atan(s.score) / pi(), 0.0::DOUBLE)
             + 1.0::DOUBLE * coalesce(0.5::DOUBLE + atan(d.score) / pi(), 0.0::DOUBLE), 9) AS score
FROM sparse_hits s FULL OUTER JOIN dense_hits d ON s.query_id = d.query_id AND s.pk = d.pk""")
cte("hybrid", """
SELECT * FROM (SELECT query_id, pk, score,
                      CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS INTEGER) AS rank
               FROM fused) WHERE rank <= 4""")
cte("hit_text", f"""
SELECT h.query_id, h.rank, h.pk, replace(c.text, {NL}, '') AS text FROM hybrid h JOIN coll c ON c.pk = h.pk""")

q("sparse_vectors", "SELECT id AS pk, term, round(w, 6) AS w FROM svec")
q("dense_topk", "SELECT query_id, pk, score, rank FROM dense_hits")
q("sparse_topk", "SELECT query_id, pk, score, rank FROM sparse_hits")
q("weighted_fusion", """SELECT query_id, pk, sparse_score,
                               dense_score, score FROM fused""")
q("hybrid_search", "SELECT query_id, pk, score, rank FROM hybrid")
q("hit_texts", "SELECT * FROM hit_text")
q("vector_context", f"""
SELECT q.query_id, concat_ws({NL}, '*** Hybrid search results:', b.block) AS context
FROM vq q LEFT JOIN (SELECT query_id, string_agg(CAST(rank AS VARCHAR) || '. ' || text || {NL} || repeat('-', 40), {NL} ORDER BY rank) AS block
                     FROM hit_text GROUP BY query_id) b ON b.query_id = q.query_id""")
q("collection_create", """SELECT CAST(('0x' || substr(md5(path || chr(10) || text), 1, 15)) AS BIGINT) AS pk, path, context, metadata
                          FROM coll WHERE strlen(text) <= 16384 AND strlen(path) <= 8192 AND strlen(context) <= 8192
                            AND strlen(metadata) <= 4096""")
q("collection_length_check", """SELECT pk, strlen(text) AS text_bytes, strlen(path) AS path_bytes,
    strlen(context) AS context_bytes, strlen(metadata) AS metadata_bytes,
    strlen(text) <= 16384 AND strlen(path) <= 8192 AND strlen(context) <= 8192 AND strlen(metadata) <= 4096 AS accepted
    FROM coll""")
q("collection_info", """SELECT 'chunks' AS name, count(*) AS n_rows, (SELECT count(DISTINCT id) FROM svec) AS n_sparse,
    count(dense_vector) AS n_dense FROM coll""")


from skein.plans import oracle_prep  # noqa: E402,F401
from skein.plans import oracle_models  # noqa: E402,F401

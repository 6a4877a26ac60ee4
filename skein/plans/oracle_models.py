"""DuckDB oracles: multi-model scoring (G) and the question pipeline (H)."""

from __future__ import annotations

from skein.plans.oracle import GRAPH_CONTEXT, NL, TERMS_RE, cte, q
from skein.plans.oracle_prep import lists, scorer, strip  # noqa: F401  (pairs CTE registered there)


def normalized(raw: str, mapped: bool) -> tuple[str, str]:
    tail = f"string_split({raw}, '_')[-1]"

    def lookup(x):
        if not mapped:
            return "NULL"
        return f"CASE {x} WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END"

    digits = f"regexp_full_match({raw}, '[0-9]+')"
    label = (f"CASE WHEN {digits} THEN coalesce({lookup(f'TRY_CAST({raw} AS INTEGER)')}, {raw}) "
             f"WHEN contains({raw}, '_') AND TRY_CAST({tail} AS INTEGER) IS NOT NULL "
             f"THEN coalesce({lookup(f'TRY_CAST({tail} AS INTEGER)')}, {raw}) "
             f"WHEN contains({raw}, '_') THEN NULL ELSE {raw} END")
    err = (f"CASE WHEN NOT {digits} AND contains({raw}, '_') AND TRY_CAST({tail} AS INTEGER) IS NULL "
           f"THEN 'invalid literal for int() with base 10: ''' || {tail} || '''' END")
    return label, err


cte("mm_raw", """
SELECT doc_id AS row_id, 'digits' AS model, CAST(doc_id % 8 AS VARCHAR) AS raw_label,
       (doc_id % 997) / 997.0::DOUBLE AS score, true AS mapped FROM documents
UNION ALL
SELECT doc_id, 'prefixed', 'LABEL_' || CASE WHEN doc_id % 37 = 0 THEN 'x' ELSE CAST(doc_id % 10 AS VARCHAR) END,
       (doc_id % 991) / 991.0::DOUBLE, true FROM documents
UNION ALL
SELECT doc_id, 'named', CASE WHEN length(text) > 2000 THEN 'positive' ELSE 'negative' END,
       (doc_id % 983) / 983.0::DOUBLE, false FROM documents""")
_L1, _E1 = normalized("raw_label", True)
_L0, _E0 = normalized("raw_label", False)
cte("mm_norm", f"""
SELECT row_id, model, raw_label, CASE WHEN mapped THEN {_L1} ELSE {_L0} END AS label,
       CASE WHEN mapped THEN {_E1} ELSE {_E0} END AS error, score FROM mm_raw""")
cte("mm_all", """
SELECT row_id, model, 'text-classification' AS task, label, CASE WHEN error IS NULL THEN score END AS score,
       CAST(NULL AS VARCHAR) AS generated_text, error FROM mm_norm
UNION ALL
SELECT doc_id, 'writer', 'text-generation', NULL, CASE WHEN doc_id % 2 = 1 THEN (doc_id % 101) / 101.0::DOUBLE END,
       CAST(len(regexp_extract_all(lower(text), """ + TERMS_RE + """)) AS VARCHAR) || ' terms', NULL FROM documents""")

q("multi_model_score", """SELECT row_id, model, task, label, round(score, 6) AS score, generated_text, error
                          FROM mm_all""")
q("label_normalize", "SELECT row_id, model, raw_label, label, error FROM mm_norm")
q("result_lines", """
SELECT row_id, model,
       CASE WHEN error IS NOT NULL THEN model || ': Error - ' || error
            WHEN label IS NOT NULL THEN model || ': ' || label || ' (Confidence: ' || printf('%.4f', score) || ')'
            WHEN generated_text IS NOT NULL
              THEN model || ': Generated Text - ' || generated_text || ' (Score: ' || coalesce(CAST(score AS VARCHAR), 'None') || ')'
            ELSE model || ': ' END AS line
FROM mm_all""")

q("model_errors", """
SELECT doc_id AS row_id, 'fragile' AS model,
       CASE WHEN length(text) % 7 = 0 THEN NULL WHEN length(text) % 2 = 1 THEN 'positive' ELSE 'negative' END AS label,
       CASE WHEN length(text) % 7 = 0 THEN 'cannot score a text of ' || CAST(length(text) AS VARCHAR) || ' characters' END
         AS error
FROM documents""")

# Texts read as missing, as in the CSV reader.
NA_TOKENS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
             "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")
q("scan_training_csv", f"""
SELECT row_id, CASE WHEN prompt IN ({NA_TOKENS}) THEN NULL ELSE prompt END AS prompt,
       CASE WHEN sentence IN ({NA_TOKENS}) THEN NULL ELSE sentence END AS sentence,
       CASE WHEN label IN ({NA_TOKENS}) THEN NULL ELSE label END AS label
FROM pairs""")

# ------------------------------------------------------------------ pipeline
cte("g_ctx", f"""
SELECT p.prompt_id, p.prompt, {GRAPH_CONTEXT} AS graph_context
FROM prompts p LEFT JOIN ctx_blocks b ON b.prompt_id = p.prompt_id""")
cte("pvec", f"""
SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS w FROM (
  SELECT t.id, t.term, t.tf * i.idf AS raw FROM (
    SELECT id, term, count(*) AS tf FROM (
      SELECT prompt_id AS id, unnest(regexp_extract_all(lower(prompt), {TERMS_RE})) AS term FROM prompts)
    GROUP BY id, term) t JOIN vidf i ON i.term = t.term)""")
cte("pq", """
SELECT p.prompt_id, e.embedding AS dense_vector FROM prompts p
JOIN embeddings e ON e.vec_id = CASE WHEN p.prompt_id >= 1000 THEN p.prompt_id - 1000 ELSE p.prompt_id + 100 END""")
cte("p_sparse", """
SELECT * FROM (SELECT query_id, pk, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS srank
  FROM (SELECT q.id AS query_id, d.id AS pk, round(sum(q.w * d.w), 9) AS score FROM pvec q JOIN svec d ON q.term = d.term GROUP BY q.id, d.id))
WHERE srank <= 4""")
cte("p_dense", """
SELECT * FROM (SELECT query_id, pk, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS drank
  FROM (SELECT q.prompt_id AS query_id, c.pk,
               round(list_inner_product(CAST(q.dense_vector AS DOUBLE[]), CAST(c.dense_vector AS DOUBLE[])), 9) AS score
        FROM pq q JOIN coll c ON c.dense_vector IS NOT NULL))
WHERE drank <= 4""")
cte("p_hybrid", """
SELECT * FROM (
  SELECT query_id, pk, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pk) AS INTEGER) AS rank
  FROM (SELECT coalesce(s.query_id, d.query_id) AS query_id, coalesce(s.pk, d.pk) AS pk,
               round(0.7::DOUBLE * coalesce(0.5::DOUBLE + atan(s.score) / pi(), 0.0::DOUBLE)
                     + 1.0::DOUBLE * coalesce(0.5::DOUBLE + atan(d.score) / pi(), 0.0::DOUBLE), 9) AS score
        FROM p_sparse s FULL OUTER JOIN p_dense d ON s.query_id = d.query_id AND s.pk = d.pk))
WHERE rank <= 4""")
cte("v_ctx", f"""
SELECT p.prompt_id, concat_ws({NL}, '*** Hybrid search results:', b.block) AS vector_context
FROM prompts p LEFT JOIN (
  SELECT h.query_id, string_agg(CAST(h.rank AS VARCHAR) || '. ' || replace(c.text, {NL}, '') || {NL} || repeat('-', 40),
                                {NL} ORDER BY h.rank) AS block
  FROM p_hybrid h JOIN coll c ON c.pk = h.pk GROUP BY h.query_id) b ON b.query_id = p.prompt_id""")
cte("merged", """
SELECT g.prompt_id, g.prompt, g.graph_context, coalesce(v.vector_context, '') AS vector_context
FROM g_ctx g LEFT JOIN v_ctx v ON v.prompt_id = g.prompt_id""")


def filtered(ctx: str) -> str:
    return (f"array_to_string(list_filter(list_transform({lists(ctx)}, lambda s: {strip('s')}), "
            f"lambda s: {scorer('prompt', 's')} = 1), ' ')")


# The answer prompt template in SQL.
TEMPLATE = ("'Using the provided contexts, respond concisely and exactly to the question. "
            "Answer only from the two contexts given below.' || chr(10) || chr(10) || '            context1: ' "
            "|| graph_context || chr(10) || chr(10) || '            context2: ' || vector_context "
            "|| chr(10) || chr(10) || '            question: ' || prompt || chr(10) || '            '")

q("merge_contexts", "SELECT prompt_id, graph_context, vector_context FROM merged")
q("render_prompt", f"SELECT prompt_id, {TEMPLATE} AS prompt_text FROM merged")
q("ask_pipeline", f"""SELECT prompt_id, {filtered('graph_context')} AS graph_context,
                             {filtered('vector_context')} AS vector_context FROM merged""")
q("filter_context", f"SELECT prompt_id, {filtered('graph_context')} AS filtered_context FROM g_ctx")

cte("answers", f"""
SELECT prompt_id, {TEMPLATE} AS prompt_text FROM (
  SELECT prompt_id, prompt, {filtered('graph_context')} AS graph_context, {filtered('vector_context')} AS vector_context FROM merged)""")
q("ask_answer", """
SELECT prompt_id, CASE WHEN length(prompt_text) % 7 <> 0 THEN CAST(length(prompt_text) AS VARCHAR) || ' characters' END AS llm_response,
       CASE WHEN length(prompt_text) % 7 = 0 THEN 'cannot answer' END AS llm_error FROM answers""")

# ------------------------------------------------------------------ fitted models: what must hold for any fit


def split_of(rows: str) -> str:
    """row_id, label_id, split of the stratified split of ``rows`` (row_id, label_id)."""
    return f"""
SELECT e.row_id, e.label_id, CASE WHEN e.cidx < x.n_test THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS cidx FROM {rows}) e
JOIN (SELECT label_id, base + CASE WHEN rrank <= n_test_total - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM (
  SELECT label_id, (2 * n) // 10 AS base, (2 * sum(n) OVER () + 9) // 10 AS n_test_total,
         row_number() OVER (ORDER BY (2 * n) % 10 DESC, label_id) AS rrank
  FROM (SELECT label_id, count(*) AS n FROM {rows} GROUP BY label_id))) x ON x.label_id = e.label_id"""


cte("bin_rows", f"""
SELECT row_id, CASE lower({strip("coalesce(label, 'nan')")}) WHEN 'unnecessary' THEN 0 ELSE 1 END AS label_id
FROM pairs WHERE lower({strip("coalesce(label, 'nan')")}) IN ('unnecessary', 'necessary')""")
cte("bin_split", split_of("bin_rows"))
cte("lang_rows", """
SELECT doc_id AS row_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id FROM documents""")
cte("lang_split", split_of("lang_rows"))
q("model_roundtrip", "SELECT row_id, true AS same FROM bin_split WHERE split = 'test'")
q("predict_pairs", "SELECT doc_id, pos, true AS known FROM s_rows")
q("fit_binary", """SELECT count(*) AS n, count(*) FILTER (WHERE label_id = 1) AS n_positive, true AS better_than_chance
                   FROM bin_split WHERE split = 'test'""")
q("predict_table", "SELECT row_id, label_id, true AS known FROM lang_split WHERE split = 'test'")
q("fit_multiclass", """
SELECT CAST(label_id AS VARCHAR) AS class_name, count(*) AS support, CAST(NULL AS BOOLEAN) AS beats_majority
FROM lang_split WHERE split = 'test' GROUP BY label_id
UNION ALL SELECT 'accuracy', count(*), true FROM lang_split WHERE split = 'test'""")
q("select_best", """
SELECT CAST(o AS INTEGER) AS candidate_order, '{''reg_param'': ' || r || '}' AS setting, true AS best_is_first_maximum
FROM (VALUES (0, '0.0'), (1, '0.01'), (2, '0.1')) t(o, r)""")
q("fitted_models_score", """
SELECT doc_id AS row_id, model, true AS same FROM documents, (VALUES ('setting 0'), ('setting 1'), ('setting 2')) m(model)""")

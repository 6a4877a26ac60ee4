"""DuckDB oracles: sentences (D), preparation (E), metrics (F)."""

from __future__ import annotations

from skein.plans.oracle import NL, TERMS_RE, cte, q

SENT = r"'[^.!?\n]+[.!?]*'"
STRIP = r"'^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$'"
DEFAULT_PROMPT = "'Is this sentence necessary for understanding the context?'"


def lists(text: str) -> str:
    return (f"CASE WHEN coalesce({text}, '') = '' THEN CAST([] AS VARCHAR[]) "
            f"WHEN len(regexp_extract_all({text}, {SENT})) = 0 THEN [{text}] "
            f"ELSE regexp_extract_all({text}, {SENT}) END")


def strip(x: str) -> str:
    return f"regexp_replace({x}, {STRIP}, '', 'g')"


def scorer(prompt: str, sentence: str) -> str:
    st = f"regexp_extract_all(lower({sentence}), {TERMS_RE})"
    pt = f"regexp_extract_all(lower({prompt}), {TERMS_RE})"
    return f"CASE WHEN len(list_intersect(list_distinct({st}), {pt})) > 0 OR len({st}) >= 8 THEN 1 ELSE 0 END"


def decode(cid: str) -> str:
    return f"CASE {cid} WHEN 0 THEN 'unnecessary' WHEN 1 THEN 'necessary' ELSE 'unknown' END"


# ------------------------------------------------------------------ sentences
cte("s_texts", """
SELECT doc_id, text FROM documents
UNION ALL SELECT * FROM (VALUES (-1, ''), (-2, '...'), (-3, 'This is a test. This is another test.')) t(doc_id, text)""")
cte("s_lists", f"SELECT doc_id, {lists('text')} AS sentences FROM s_texts")
cte("s_rows", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, sentences[i] AS sentence
FROM (SELECT doc_id, sentences, unnest(generate_series(1, len(sentences))) AS i FROM s_lists)""")
cte("conv_prompt", """
SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id""")
cte("conv_sent", f"""
SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, {strip('l[i]')} AS sentence
FROM (SELECT conv_id, turn, l, unnest(generate_series(1, len(l))) AS i
      FROM (SELECT conv_id, turn, {lists('text')} AS l FROM conversations WHERE role = 'assistant'))""")
cte("scores4", """
SELECT vec_id AS row_id, label % 4 AS label,
       list_transform([0, 1, 2, 3], lambda k: round(list_sum(list_transform(
           list_slice(embedding, k * (len(embedding) // 4) + 1, (k + 1) * (len(embedding) // 4)), lambda x: CAST(x AS DOUBLE))), 6)) AS scores
FROM embeddings""")
cte("mc", """
SELECT row_id, label, scores, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS prediction FROM scores4""")

q("sentence_split", "SELECT * FROM s_rows")
q("sentence_split_stripped", f"SELECT doc_id, pos, {strip('sentence')} AS sentence FROM s_rows")
q("sentence_split_edge", """SELECT doc_id, CAST(len(sentences) AS INTEGER) AS n_sentences,
                                   array_to_string(sentences, ' || ') AS sentences FROM s_lists""")
q("pair_text", """SELECT s.conv_id, s.turn, s.pos, p.prompt || ' [SEP] ' || s.sentence AS pair_text
                  FROM conv_prompt p JOIN conv_sent s ON s.conv_id = p.conv_id""")
q("label_decode", f"SELECT row_id, prediction, {decode('prediction')} AS label FROM mc")
q("necessary_sentences", f"""
SELECT doc_id, pos, sentence FROM (SELECT doc_id, pos, {strip('sentence')} AS sentence FROM s_rows)
WHERE {scorer(DEFAULT_PROMPT, 'sentence')} = 1""")
q("predict_nested", f"""
SELECT p.conv_id, s.turn, s.pos, s.sentence,
       CASE WHEN s.sentence IS NULL THEN NULL ELSE {decode(scorer('p.prompt', 's.sentence'))} END AS label
FROM conv_prompt p LEFT JOIN conv_sent s ON s.conv_id = p.conv_id""")

# ------------------------------------------------------------------ preparation (P)
cte("pairs", f"""
SELECT l.doc_id * 1000000000 + coalesce(i - 1, 0) AS row_id,
       CASE WHEN l.doc_id % 17 = 0 THEN NULL ELSE 'Is this passage from ' || d.source || ' useful?' END AS prompt,
       CASE WHEN l.doc_id % 13 = 0 THEN NULL ELSE s[i] END AS sentence,
       CASE WHEN l.doc_id % 19 = 0 THEN NULL
            WHEN l.doc_id % 11 = 0 THEN 'maybe'
            WHEN l.doc_id % 5 = 0 THEN CASE WHEN l.quality = 1 THEN ' Necessary ' ELSE ' Unnecessary ' END
            ELSE CASE WHEN l.quality = 1 THEN 'necessary' ELSE 'unnecessary' END END AS label
FROM labels l JOIN (
  SELECT doc_id, source, s, unnest(CASE WHEN len(s) = 0 THEN [NULL] ELSE generate_series(1, len(s)) END) AS i
  FROM (SELECT doc_id, source, regexp_extract_all(text, {SENT}) AS s FROM documents)) d ON d.doc_id = l.doc_id""")
cte("dropped", """
SELECT row_id, prompt || ' [SEP] ' || sentence AS input_text, label FROM pairs
WHERE prompt IS NOT NULL AND sentence IS NOT NULL AND label IS NOT NULL""")
cte("label_ids", """
SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
FROM (SELECT DISTINCT label FROM dropped)""")
cte("enc", "SELECT d.row_id, d.input_text, l.label_id FROM dropped d JOIN label_ids l ON l.label = d.label")
cte("major", """
SELECT arg_max(label_id, n * 100000 - label_id) AS majority FROM (SELECT label_id, count(*) AS n FROM enc GROUP BY label_id)""")
cte("parts", """
SELECT e.*, CASE WHEN e.label_id = m.majority THEN 'majority' ELSE 'rest' END AS part FROM enc e, major m""")
cte("rest_idx", "SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS ridx FROM parts WHERE part = 'rest'")
cte("quota", """
SELECT label_id, n, base + CASE WHEN rrank <= n_test_total - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM (
  SELECT label_id, n, (2 * n) // 10 AS base, (2 * n) % 10 AS rem, (2 * sum(n) OVER () + 9) // 10 AS n_test_total,
         row_number() OVER (ORDER BY (2 * n) % 10 DESC, label_id) AS rrank
  FROM (SELECT label_id, count(*) AS n FROM enc GROUP BY label_id))""")
cte("splits", """
SELECT e.row_id, e.label_id, CASE WHEN e.cidx < q.n_test THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS cidx
  FROM enc) e JOIN quota q ON q.label_id = e.label_id""")
cte("vocab_ids", f"""
SELECT term, CAST(row_number() OVER (ORDER BY cnt DESC, term) + 1 AS INTEGER) AS token_id FROM (
  SELECT term, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(lower(input_text), {TERMS_RE})) AS term FROM enc)
  GROUP BY term)""")
cte("fixed_len", f"""
SELECT row_id,
       array_to_string(list_resize(list(token_id ORDER BY pos), 128, 0), ' ') AS input_ids,
       array_to_string(list_resize(list(1 ORDER BY pos), 128, 0), ' ') AS attention_mask
FROM (SELECT t.row_id, t.pos, coalesce(v.token_id, 1) AS token_id FROM (
        SELECT row_id, i - 1 AS pos, l[i] AS term FROM (
          SELECT row_id, l, unnest(generate_series(1, least(len(l), 128))) AS i FROM (
            SELECT row_id, regexp_extract_all(lower(input_text), {TERMS_RE}) AS l FROM enc))) t
      LEFT JOIN vocab_ids v ON v.term = t.term)
GROUP BY row_id""")

q("input_text_keep", """SELECT row_id, coalesce(prompt, 'nan') || ' [SEP] ' || coalesce(sentence, 'nan') AS input_text
                        FROM pairs""")
q("input_text_drop", "SELECT * FROM dropped")
q("dropped_counts", """SELECT count(*) AS n_input,
    count(*) FILTER (WHERE NOT (prompt IS NOT NULL AND sentence IS NOT NULL AND label IS NOT NULL)) AS n_dropped,
    count(*) FILTER (WHERE prompt IS NOT NULL AND sentence IS NOT NULL AND label IS NOT NULL) AS n_remaining
    FROM pairs""")
LABEL_OR_NAN = "coalesce(label, 'nan')"
q("label_clean", f"SELECT row_id, lower({strip(LABEL_OR_NAN)}) AS label_clean FROM pairs")
q("label_map_fixed", f"""
SELECT row_id, coalesce(prompt, 'nan') || ' [SEP] ' || coalesce(sentence, 'nan') AS input_text,
       CAST(CASE lower({strip("coalesce(label, 'nan')")}) WHEN 'unnecessary' THEN 0 WHEN 'necessary' THEN 1 END AS INTEGER) AS label
FROM pairs WHERE lower({strip("coalesce(label, 'nan')")}) IN ('unnecessary', 'necessary')""")
q("label_encode", "SELECT label, label_id FROM label_ids")
q("class_counts", "SELECT label_id, count(*) AS n FROM enc GROUP BY label_id")
q("majority_split", "SELECT row_id, label_id, part FROM parts")
q("oversample", """
SELECT row_id, label_id, CAST(-1 AS BIGINT) AS copy_id FROM parts WHERE part = 'majority'
UNION ALL
SELECT r.row_id, r.label_id, p.copy_id FROM (
  SELECT i AS copy_id,
         CAST(('0x' || substr(md5('42:' || CAST(i AS VARCHAR)), 1, 15)) AS BIGINT)
           % (SELECT count(*) FROM parts WHERE part = 'rest') AS ridx
  FROM range(0, (SELECT count(*) FROM parts WHERE part = 'majority')) t(i)) p
JOIN rest_idx r ON r.ridx = p.ridx""")
q("stratified_split", "SELECT * FROM splits")
q("class_weights", """SELECT label_id, count(*) AS n, round(1.0::DOUBLE / count(*), 6) AS weight
                      FROM splits WHERE split = 'train' GROUP BY label_id""")
q("encode_fixed_length", "SELECT * FROM fixed_len")
q("training_columns", """SELECT f.row_id, f.input_ids, f.attention_mask, e.label_id AS labels
                         FROM fixed_len f JOIN enc e ON e.row_id = f.row_id""")

# ------------------------------------------------------------------ metrics (E)
cte("bin_eval", "SELECT quality AS label, 1 - toxic AS prediction FROM labels")
cte("per_class", """
SELECT cls, sum(t) AS support, sum(pr) AS pred, sum(c) AS tp FROM (
  SELECT label AS cls, 1 AS t, 0 AS pr, CASE WHEN label = prediction THEN 1 ELSE 0 END AS c FROM mc
  UNION ALL SELECT prediction, 0, 1, 0 FROM mc) GROUP BY cls""")
cte("per_class_m", """
SELECT cls, support, tp,
       coalesce(CAST(tp AS DOUBLE) / nullif(pred, 0), 0.0) AS precision,
       coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall,
       coalesce(CAST(2 * tp AS DOUBLE) / nullif(pred + support, 0), 0.0) AS f1
FROM per_class""")

q("argmax_class", "SELECT row_id, label, prediction FROM mc")
q("binary_metrics", """
SELECT round(coalesce(CAST(hit AS DOUBLE) / nullif(n, 0), 0.0), 6) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0.0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(ap, 0), 0.0), 6) AS recall,
       round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(pp + ap, 0), 0.0), 6) AS f1
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS hit,
             count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
             count(*) FILTER (WHERE prediction = 1) AS pp, count(*) FILTER (WHERE label = 1) AS ap FROM bin_eval)""")
q("classification_report", """
SELECT CAST(cls AS VARCHAR) AS class_name, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per_class_m
UNION ALL
SELECT 'accuracy', NULL, NULL, round(coalesce(CAST(sum(tp) AS DOUBLE) / nullif(sum(support), 0), 0.0), 6),
       CAST(sum(support) AS BIGINT) FROM per_class_m
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM per_class_m
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class_m""")
q("confusion_matrix", """
SELECT t.cls AS true_class, p.cls AS pred_class, coalesce(c.n, 0) AS n
FROM (SELECT DISTINCT cls FROM per_class) t CROSS JOIN (SELECT DISTINCT cls FROM per_class) p
LEFT JOIN (SELECT label, prediction, count(*) AS n FROM mc GROUP BY label, prediction) c
  ON c.label = t.cls AND c.prediction = p.cls""")
q("avg_loss_accuracy", """
SELECT round(avg(-ln(greatest(probs[label + 1], 1e-15::DOUBLE))), 6) AS avg_loss,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM (SELECT label, prediction,
             list_transform(scores, lambda x: exp(x - list_max(scores)) / list_sum(list_transform(scores, lambda y: exp(y - list_max(scores))))) AS probs FROM mc)""")
q("best_candidate", """
SELECT candidate, round(f1, 6) AS f1 FROM (
  SELECT 'length>' || CAST(threshold AS VARCHAR) AS candidate, candidate_order,
         round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(pp + ap, 0), 0.0), 9) AS f1
  FROM (SELECT r.candidate_order, r.threshold,
               count(*) FILTER (WHERE d.n_chars > r.threshold AND l.quality = 1) AS tp,
               count(*) FILTER (WHERE d.n_chars > r.threshold) AS pp,
               count(*) FILTER (WHERE l.quality = 1) AS ap
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id
        CROSS JOIN (VALUES (0, 500), (1, 1000), (2, 2000), (3, 4000)) r(candidate_order, threshold)
        GROUP BY r.candidate_order, r.threshold))
ORDER BY f1 DESC, candidate_order LIMIT 1""")

"""DuckDB statements of the corpus queries that SQL can express.

The others have none and are tested against brute force, round trips or
held-out accuracy in ``tests/llm``: tokenizer ids (op2, op5), XXH64 shingles
(op4), keyed surrogates (op3), trained models (op6, op9, op10) and the
pipeline.
"""

from __future__ import annotations

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS g FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: w[i:i + 9])) AS g
    FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, spot.n FROM spot JOIN win ON spot.n = win.n AND spot.g = win.g),
marked AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT body, min(page_id) AS head FROM p GROUP BY body),
bits AS (
  SELECT page_id, body, list_transform(range(0, 4), lambda k:
      list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(1, 11), lambda j:
        CAST(strpos('0123456789abcdef', substr(h, 10 * k + j, 1)) - 1 AS BIGINT))), lambda x, y: x * 16 + y)) AS v
  FROM p)
SELECT bits.page_id, CAST(octet_length(encode(bits.body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM bits JOIN g ON g.body = bits.body"""

OP11 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
held AS (SELECT doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM held) GROUP BY doc_id, n, t),
item AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) GROUP BY item_id, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY t, docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM item JOIN tf USING (t) JOIN w USING (t), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

OP12 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
         role, coalesce(text, '') AS text,
         length(regexp_replace(coalesce(text, ''), '<(\\*)(/?turn)', '<\1\\\2', 'g'))
         + coalesce(1 + length(role) + length(regexp_replace(role, '[^\\<>\n]', '', 'g')), 0) + 15 AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

ORACLES: dict[str, str] = {"op1_embedding_dedup": OP1, "op7_decontaminate": OP7, "op8_warc": OP8, "op11_lexical_search": OP11,
                           "op12_chat_format": OP12}

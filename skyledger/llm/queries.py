"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from skyledger.llm.byte_bpe import op5_byte_bpe
from skyledger.llm.chat import CONTROL, END, TEXT, TURN, op4_reply_trees
from skyledger.llm.graph_search import op6_graph_search
from skyledger.llm.hamming import NEAREST, op10_hamming_top_k
from skyledger.llm.html_extraction import op12_html_extraction
from skyledger.llm.near_duplicates import op1_minhash_near_dedup
from skyledger.llm.packing import op3_mixture_packing
from skyledger.llm.secret_scan import op8_secret_scan
from skyledger.llm.spelling import op13_spelling_variants
from skyledger.llm.spelling_sql import SQL as _SPELLING
from skyledger.llm.token_alignment import op11_token_alignment
from skyledger.llm.token_counts import op7_token_counts
from skyledger.llm.toxicity import op9_toxicity
from skyledger.llm.urls import RULES, op2_url_filters

QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_minhash_near_dedup, op2_url_filters, op3_mixture_packing, op4_reply_trees, op5_byte_bpe,
        op6_graph_search, op7_token_counts, op8_secret_scan, op9_toxicity, op10_hamming_top_k,
        op11_token_alignment, op12_html_extraction, op13_spelling_variants,
    )
}

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), {_ASCII}), '[\\x20\\x09-\\x0D]+')
                  if x <> ''] AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) END AS sh
  FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS v FROM s),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.v = y.v AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(reach.b) AS component_id, min(reach.b) = s.doc_id AS kept
FROM s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, len(s.sh)
"""

_URLS = f"""
WITH rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_ASCII}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits USING (page_id)
"""

_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN) + len(TEXT) + len(END)} + length(regexp_replace(role, '{CONTROL}', '\\1\\\\\\2\\3', 'g'))
      + length(regexp_replace(text, '{CONTROL}', '\\1\\\\\\2\\3', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

_HAMMING = f"""
WITH c AS (
  SELECT vec_id, [coalesce(embedding[i] > 0, false) for i in range(1, 65)] AS bits
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL]) = 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum([(q.bits[i] <> c.bits[i])::INTEGER for i in range(1, 65)])::INTEGER AS distance
  FROM c q JOIN c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d
) WHERE rank <= {NEAREST}
"""

SQL = {
    "op1_minhash_near_dedup": _NEAR_DUPLICATES,
    "op2_url_filters": _URLS,
    "op4_reply_trees": _CHAT,
    "op10_hamming_top_k": _HAMMING,
    "op13_spelling_variants": _SPELLING,
}

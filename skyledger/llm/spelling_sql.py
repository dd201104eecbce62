"""The SQL counterpart of ``op13_spelling_variants``."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
WITH RECURSIVE bits AS (
  SELECT n, 0 AS step, n::BIGINT AS v FROM range(256) t(n)
  UNION ALL
  SELECT n, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8
), crc AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w
    FROM documents
  ) GROUP BY ALL
), hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || substr(h, 2 * i + 1, 2))::BIGINT for i in range(0, length(h) // 2)]),
    lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]))) AS h
  FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS h FROM runs), crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INTEGER) || substr(w, (h % length(w) + 2)::INTEGER) ELSE w END AS word,
    sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word)))::INTEGER AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most, first(near ORDER BY near_n DESC, encode(near)) AS best FROM near GROUP BY word
), judged AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN best END AS form,
    CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS here, 0 AS step FROM judged
  UNION ALL
  SELECT chain.word, judged.form, step + 1 FROM chain JOIN judged ON chain.here = judged.word WHERE judged.form IS NOT NULL
), roots AS (SELECT word, max_by(here, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM judged JOIN roots USING (word)
"""

"""SQL for the queries of this subpackage that SQL can express."""

_OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
),
late AS (
  SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths)
),
hit AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, k)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS p FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
),
f AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY lang, k, p),
cand AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
longer AS (
  SELECT lang, p, max(a) AS m FROM (
    SELECT lang, list_slice(p, 1, 2) AS p, a FROM cand WHERE k = 3
    UNION ALL SELECT lang, list_slice(p, 2, 3), a FROM cand WHERE k = 3) GROUP BY lang, p
),
cuts AS (
  SELECT c.lang, c.k, c.p, c.a, cut, list_slice(c.p, 1, cut) AS p1, list_slice(c.p, cut + 1, c.k) AS p2
  FROM cand c JOIN (SELECT unnest([1, 2]) AS cut) ON cut < c.k LEFT JOIN longer USING (lang, p)
  WHERE m IS NULL OR 100 * m < 50 * c.a
),
scored AS (
  SELECT c.lang, c.p, c.a, cut, f1.a AS l, f2.a AS r,
    ((1000000::HUGEINT * c.a * c.a) // (f1.a::HUGEINT * f2.a))::BIGINT AS score
  FROM cuts c JOIN f f1 ON f1.lang = c.lang AND f1.p = c.p1 JOIN f f2 ON f2.lang = c.lang AND f2.p = c.p2
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
placed AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM best
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM placed JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

LLM_ORACLE: dict[str, str] = {"op1_substring_dedup": _OP1, "op6_decontamination": _OP6, "op11_phrases": _OP11}

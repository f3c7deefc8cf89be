"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(breaks: str) -> str:
    return f"list_filter(string_split_regex({_LOWER}, '{breaks}'), lambda x: x <> '')"


NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_words('[\\x09-\\x0D\\x20]+')} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM words WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * c >= 85 * (s.n + t.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id
"""

DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, {_words('[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM documents),
iw AS (SELECT item_id, {_words('[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
spans AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)),
hits AS (SELECT doc_id, i, s.n, item_id FROM spans s JOIN windows v ON s.g = v.g AND s.n = v.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
r AS (SELECT *, n >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY html) AS again, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN newest END AS refers_to FROM r
"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM d),
r AS (SELECT *, CAST(len(w) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS k FROM u),
c AS (SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= 50 THEN 'plain' WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""

# Costs of what follows each turn, from the last one backwards by state of the grammar, then a walk that takes the
# ASCII-least letter among the cheapest at each step. crc32 is worked out bit by bit.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(unicode(substr(k, i, 1)) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
faults AS (
  SELECT *, CASE WHEN role = '' THEN ' ' ELSE substr(role, 1, 1) END AS x, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM ordered),
rows_ AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS late, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS x0 FROM faults),
back AS (
  SELECT conv_id, n AS i, 0 AS c0, 6 AS cs, 3 AS cu, 0 AS ca FROM rows_ WHERE i = 1
  UNION ALL
  SELECT conv_id, i, least(b0, 3 + bu, 6 + ba), least(bs, 3 + bu, 6 + ba), least(bu, 3 + ba), least(ba, 3 + bu) FROM (
    SELECT r.conv_id, r.i - 1 AS i,
      least(4 + c0, CASE WHEN NOT gone THEN late + cu + CASE x WHEN 'u' THEN 0 ELSE 3 END END, CASE WHEN NOT gone AND x = 's' THEN late + cs END) AS b0,
      least(4 + cs, CASE WHEN NOT gone THEN late + cu + CASE x WHEN 'u' THEN 0 ELSE 3 END END) AS bs,
      least(4 + cu, CASE WHEN NOT gone THEN late + ca + CASE x WHEN 'a' THEN 0 ELSE 3 END END) AS bu,
      least(4 + ca, CASE WHEN NOT gone THEN late + cu + CASE x WHEN 'u' THEN 0 ELSE 3 END END) AS ba
    FROM back b JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i) AS s),
ahead AS (
  SELECT b.conv_id, b.i, map {'0': b.c0, 's': b.cs, 'u': b.cu, 'a': b.ca} AS now, map {'0': d.c0, 's': d.cs, 'u': d.cu, 'a': d.ca} AS later, r.x, r.gone, r.late, r.role, r.text
  FROM back b LEFT JOIN back d ON d.conv_id IS NOT DISTINCT FROM b.conv_id AND d.i = b.i + 1 LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines, false AS ended FROM rows_ WHERE i = 1
  UNION ALL
  SELECT conv_id, CASE letter WHEN 'I' THEN i WHEN '' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN q WHEN '' THEN q WHEN 'K' THEN x ELSE f END, audit || letter,
    CASE letter WHEN 'I' THEN list_append(lines, name || ':') WHEN 'R' THEN list_append(lines, name || ':' || text) WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE lines END, letter = ''
  FROM (
    SELECT *, CASE f WHEN 'u' THEN 'user' ELSE 'assistant' END AS name, CASE WHEN later['0'] IS NOT NULL AND now[q] = 4 + later[q] THEN 'D' WHEN now[q] = 3 + now[f] THEN 'I'
      WHEN later['0'] IS NULL THEN '' WHEN (x = f OR q = '0' AND x = 's') AND now[q] = late + later[x] THEN 'K' ELSE 'R' END AS letter
    FROM (SELECT w.*, a.now, a.later, a.x, a.late, a.role, a.text, CASE w.q WHEN 'u' THEN 'a' ELSE 'u' END AS f
      FROM walk w JOIN ahead a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i WHERE NOT w.ended) AS s) AS s),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (x0 IS NOT NULL AND x0 || x NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.c0, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk w ON w.ended AND w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN back b ON b.i = 0 AND b.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL = {
    "op2_ngram_join": NGRAM_JOIN,
    "op4_decontamination": DECONTAMINATION,
    "op6_warc": WARC,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}

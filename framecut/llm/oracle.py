"""DuckDB SQL for the registered queries that SQL can express.

The others (XXH64 fingerprints, tokenizers, language models, byte suffixes)
are tested against plain Python versions in ``tests/llm``.
"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op8_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE_SQL["op4_decontamination"] = rf"""
WITH items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, list_slice(w, k + 1, k + least(len(w), 10)) AS win
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS k FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), sizes AS (
  SELECT DISTINCT len(win) AS n FROM item_windows
), doc_windows AS (
  SELECT r, n, unnest(range(0, len(w) - n + 1)) AS k FROM docs, sizes WHERE len(w) >= n
), found AS (
  SELECT d.r, x.k, x.n, i.item_id
  FROM doc_windows x JOIN docs d ON d.r = x.r
  JOIN item_windows i ON i.win = list_slice(d.w, x.k + 1, x.k + x.n)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM found)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

_SENTENCE = r"(?:[^.!?\n]|[.!?]+[^.!?\x20\t\r\n])*[.!?]*[\x20\t\r\n]*"
_PIECE = r"[\x20\t\r\n]*(?:[^\x20\t\r\n]+[\x20\t\r\n]*){1,16}|[\x20\t\r\n]+"

ORACLE_SQL["op6_sentence_spans"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, doc_id, flatten(list_transform(
    list_filter(regexp_extract_all(text, '{_SENTENCE}'), lambda x: x <> ''),
    lambda x: CASE WHEN length(x) < 32 THEN [x] ELSE regexp_extract_all(x, '{_PIECE}') END)) AS s
  FROM docs
), trimmed AS (
  SELECT r, doc_id, list_transform(s, lambda x: trim(x, E' \t\r\n')) AS t FROM cut
), runs AS (
  SELECT r, doc_id, k, list_slice(t, k + 1, k + 3) AS span
  FROM (SELECT r, doc_id, t, unnest(range(0, len(t) - 2)) AS k FROM trimmed WHERE len(t) >= 3)
), later AS (
  SELECT r, k FROM (
    SELECT r, k, row_number() OVER (PARTITION BY span ORDER BY doc_id NULLS LAST, k) AS n FROM runs)
  WHERE n > 1
), marked AS (
  SELECT r, list(DISTINCT p) AS places FROM (SELECT r, unnest([k, k + 1, k + 2]) AS p FROM later) GROUP BY r
), flags AS (
  SELECT doc_id, s, coalesce(places, []) AS places FROM cut LEFT JOIN marked USING (r)
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(len(places) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(s, lambda x, i: NOT list_contains(places, i - 1)), '')) AS kept_sha256,
       sha256(array_to_string(list_filter(s, lambda x, i: list_contains(places, i - 1)), '')) AS removed_sha256
FROM flags
"""

# CRC-32 of a text of ASCII characters; needs the table ``crc_table``
_CRC_TABLE = """crc_table AS (
  SELECT list(t ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
    FROM range(256) r(i))
)"""


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
      [4294967295] || list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT)),
      lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)))"""


_WHITE = r"[\x20\x09-\x0D]"

ORACLE_SQL["op11_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, ids AS (
  SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
), read AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(CAST(conversations.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}
           % 20 AS fault
  FROM conversations JOIN ids ON conversations.conv_id IS NOT DISTINCT FROM ids.conv_id, crc_table
), damaged AS (
  SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END))
  FROM read WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS k FROM damaged
), rows AS (
  SELECT c, k, turn, role, text, left(role, 1) AS initial,
         CASE WHEN regexp_full_match(text, '{_WHITE}*') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 THEN 'duplicate'
              WHEN NOT regexp_full_match(text, '(?s).*[.!?]{_WHITE}*') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY k) AS earlier
  FROM placed
), steps(q, initial, kept, other) AS (  -- states: 0 start, 1 after s, 2 after u, 3 after a
  VALUES (0, 's', 1, 2), (0, 'u', 2, 2), (0, '', NULL, 2), (1, 'u', 2, 2), (1, '', NULL, 2),
         (2, 'a', 3, 3), (2, '', NULL, 3), (3, 'u', 2, 2), (3, '', NULL, 2)
), inserts(q, q2, cost, audit) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'),
         (3, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')
), edits AS (  -- of a row, by its initial and fault
  SELECT q, initial, fault, kept AS q2, CASE fault WHEN '' THEN 0 ELSE 3 END AS cost, 'K' AS audit
  FROM steps, (VALUES (''), ('truncated')) f(fault) WHERE initial <> ''
  UNION ALL SELECT q, NULL, fault, other, CASE fault WHEN '' THEN 3 ELSE 6 END, 'R'
  FROM steps, (VALUES (''), ('truncated')) f(fault) WHERE initial = ''
  UNION ALL SELECT q, NULL, NULL, q, 4, 'D' FROM steps WHERE initial = ''
), walk AS (
  SELECT c, CAST(0 AS BIGINT) AS k, q2 AS q, {{'cost': CAST(cost AS BIGINT), 'audit': audit}} AS best
  FROM ids, inserts WHERE q = 0
  UNION ALL
  SELECT w.c, w.k + 1, i.q2,
         min({{'cost': w.best.cost + e.cost + i.cost, 'audit': w.best.audit || e.audit || i.audit}})
  FROM walk w JOIN rows r ON r.c = w.c AND r.k = w.k + 1
  JOIN edits e ON e.q = w.q AND (e.initial IS NULL OR e.initial = r.initial) AND (e.fault IS NULL OR e.fault = r.fault)
  JOIN inserts i ON i.q = e.q2
  GROUP BY w.c, w.k, i.q2
), counts AS (
  SELECT c, count(r.k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND (earlier || initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ids LEFT JOIN rows r USING (c) GROUP BY c
), chosen AS (
  SELECT c, min(best) AS best FROM walk JOIN counts USING (c) WHERE k = n AND q IN (0, 3) GROUP BY c
), letters AS (
  SELECT c, p, best.audit[p] AS edit, length(best.audit) - length(replace(best.audit, 'D', '')) AS deleted,
         length(best.audit) AS n
  FROM (SELECT c, best, unnest(range(1, length(best.audit) + 1)) AS p FROM chosen)
), numbered AS (
  SELECT c, p, edit, (n - deleted) % 2 AS head, count(*) FILTER (edit <> 'I') OVER w AS k,
         count(*) FILTER (edit <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY c ORDER BY p)
), repaired AS (
  SELECT l.c, string_agg(
      CASE WHEN edit = 'K' THEN r.role WHEN (place - 1 - head) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
      CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY p) AS text
  FROM numbered l LEFT JOIN rows r ON r.c = l.c AND r.k = l.k WHERE edit <> 'D' GROUP BY l.c
)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
       sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM ids JOIN counts USING (c) JOIN chosen USING (c) LEFT JOIN repaired USING (c)
"""

ORACLE_SQL["op12_prefix_trie"] = rf"""
WITH {_CRC_TABLE}, turns AS (
  SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations
), stored AS (
  SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t.role, sha256(length(t.role) || ':' || t.role || t.text)) AS l
  FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, l, coalesce({_crc("CAST(conv_id AS VARCHAR)")} % 4, 0) AS h FROM stored, crc_table
), rebuilt AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.l, []), 1, o.h), list_slice(o.l, o.h + 1, len(o.l))) AS path
  FROM heads o LEFT JOIN heads b ON b.conv_id = o.conv_id - o.conv_id % 20
), member AS (
  SELECT conv_id, len(path) = d AS last, list_slice(path, 1, d) AS pre
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT pre, len(pre) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends,
         list_slice(pre, 1, len(pre) - 1) AS parent,
         len(list_filter(string_split_regex(coalesce(pre[len(pre)].text, ''), '{_WHITE}+'), lambda x: x <> '')) AS words
  FROM member GROUP BY pre
), children AS (
  SELECT parent AS pre, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), above AS (
  SELECT list_slice(pre, 1, d) AS pre, saved, leaf FROM (
    SELECT n.pre, (n_convs - 1) * words AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
           unnest(range(0, depth + 1)) AS d
    FROM nodes n LEFT JOIN children c ON c.pre = n.pre)
), sums AS (
  SELECT pre, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM above GROUP BY pre
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.pre = n.parent LEFT JOIN children c ON c.pre = n.pre
JOIN sums s ON s.pre = n.pre
"""

"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from pulseweave.llm.quality import LineLimits

_LIMITS = LineLimits()

_WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_NORMAL = (r"trim(regexp_replace(regexp_replace(lower({x}), '[\x20\x09-\x0D]+', ' ', 'g'),"
           r" '[0-9]+', '0', 'g'))")

QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host,
         coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, {_WORDS.format(t="text")} AS w, string_split(text, chr(10)) AS lines
        FROM docs),
grams AS (
  SELECT r, i, w[i:i + 2] AS g FROM cut, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT r, i FROM (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS o(k) GROUP BY r),
worded AS (SELECT r, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM cut),
rows_ AS (
  SELECT r, line, length(line) AS chars FROM (
    SELECT r, {_NORMAL.format(x="x")} AS line
    FROM (SELECT r, unnest(lines) AS x FROM cut)) WHERE line <> ''),
counts AS (
  SELECT host, line, min(doc_id) AS first_doc, count(DISTINCT text) AS n
  FROM rows_ JOIN docs USING (r) GROUP BY host, line),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host),
flagged AS (
  SELECT c.host, c.line, c.first_doc FROM counts c JOIN hosts h USING (host)
  WHERE c.n > {_LIMITS.min_docs} AND c.n > h.n * {_LIMITS.share}),
lost AS (
  SELECT r, sum(chars) AS n FROM rows_ JOIN docs USING (r) JOIN flagged f USING (host, line)
  WHERE docs.doc_id IS DISTINCT FROM f.first_doc GROUP BY r),
total AS (SELECT r, sum(chars) AS n FROM rows_ GROUP BY r),
base AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM docs JOIN cut USING (r) JOIN worded USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * coalesce(lost.n, 0)
           <= {_LIMITS.max_lost_percent} * coalesce(total.n, 0) AS kept
FROM base LEFT JOIN lost USING (r) LEFT JOIN total USING (r)
"""

#: Unsigned crc32 of an ASCII text, bit by bit.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform("
        "string_split({t}, ''), lambda ch: ascii(ch)::BIGINT)), lambda crc, b: "
        "list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), "
        "lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


MERKLE = rf"""
WITH RECURSIVE leaves AS (
  SELECT coalesce('=' || lang, '') AS g, doc_id, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC.format(t="doc_id::VARCHAR")} % 3 = 0
              THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree AS (
  SELECT g, 0 AS lvl, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY g, lvl, i // 8, n),
subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, i, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY lvl, i // 8, n),
fold AS (
  SELECT g, i AS leaf_at, 0 AS lvl, i, n, coalesce(tampered, leaf) AS h, '' AS proof
  FROM placed
  UNION ALL
  SELECT f.g, f.leaf_at, f.lvl + 1, f.i // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN t.i = f.i THEN f.h ELSE t.h END, '' ORDER BY t.i)),
         f.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> f.i), '')
  FROM fold f JOIN tree t ON t.g = f.g AND t.lvl = f.lvl AND t.i // 8 = f.i // 8
  WHERE f.n > 1 GROUP BY f.g, f.leaf_at, f.lvl, f.i, f.n, f.h, f.proof),
rise AS (
  SELECT f.g, f.leaf_at, 0 AS lvl, s.i, s.n, f.h, f.proof, s.h AS subroot
  FROM fold f JOIN subroots s USING (g) WHERE f.n = 1
  UNION ALL
  SELECT f.g, f.leaf_at, f.lvl + 1, f.i // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN t.i = f.i THEN f.h ELSE t.h END, '' ORDER BY t.i)),
         f.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> f.i), ''), f.subroot
  FROM rise f JOIN top t ON t.lvl = f.lvl AND t.i // 8 = f.i // 8
  WHERE f.n > 1
  GROUP BY f.g, f.leaf_at, f.lvl, f.i, f.n, f.h, f.proof, f.subroot)
SELECT p.doc_id, p.leaf, r.subroot, t.h AS root, sha256(r.proof) AS proof_sha256,
       r.h AS folded_root, r.h = t.h AS verified
FROM rise r JOIN placed p ON p.g = r.g AND p.i = r.leaf_at JOIN top t ON t.n = 1
WHERE r.n = 1
"""

#: The repair by cost: rows are taken one by one, and for every place in the pattern the least
#: (cost, edits) is kept; equal costs are compared by their edits as text.
CONVERSATIONS = rf"""
WITH RECURSIVE named AS (
  SELECT coalesce('=' || conv_id::VARCHAR, '') AS g, conv_id, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
hit AS (SELECT *, {_CRC.format(t="key")} % 20 AS hit FROM named),
rows_ AS (
  SELECT g, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                  ELSE text END AS text, copy
  FROM hit, range(2) AS c(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text),
                               copy) AS i FROM rows_),
said AS (
  SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         lag(role[1]) OVER (PARTITION BY g ORDER BY i) || role[1] AS pair FROM placed),
judged AS (
  SELECT *, bare = '' AS is_blank, bare <> '' AND nth > 1 AS is_again,
         bare <> '' AND nth = 1 AND bare[-1] NOT IN ('.', '!', '?') AS is_cut FROM said),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
         count(*) FILTER (is_cut) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY g),
-- One edit of a row; inserts in front of it are a step of their own.  A place is the last
-- initial kept, '' at the start.
inserts(place, then_, edits, lines, cost) AS (
  VALUES ('', '', '', '', 0), ('s', 's', '', '', 0), ('u', 'u', '', '', 0), ('a', 'a', '', '', 0),
         ('', 'u', 'I', chr(10) || 'user:', 2), ('s', 'u', 'I', chr(10) || 'user:', 2),
         ('a', 'u', 'I', chr(10) || 'user:', 2), ('u', 'a', 'I', chr(10) || 'assistant:', 2),
         ('', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 4),
         ('s', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 4),
         ('u', 'u', 'II', chr(10) || 'assistant:' || chr(10) || 'user:', 4),
         ('a', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 4)),
moves(edit, place, then_, cost) AS (
  VALUES ('D', '', '', 3), ('D', 's', 's', 3), ('D', 'u', 'u', 3), ('D', 'a', 'a', 3),
         ('K', '', 's', 0), ('K', '', 'u', 0), ('K', 's', 'u', 0), ('K', 'a', 'u', 0),
         ('K', 'u', 'a', 0), ('R', '', 'u', 2), ('R', 's', 'u', 2), ('R', 'a', 'u', 2),
         ('R', 'u', 'a', 2)),
best AS (
  SELECT g, 0 AS i, '' AS place, 0 AS cost, '' AS audit, '' AS lines
  FROM (SELECT DISTINCT g FROM named)
  UNION ALL
  SELECT g, i, place, c[1].cost, c[1].audit, c[1].lines FROM (
    SELECT b.g, r.i, m.then_ AS place, list_sort(list({{
        'cost': b.cost + s.cost + m.cost + CASE WHEN r.is_cut AND m.edit <> 'D' THEN 1 ELSE 0 END,
        'audit': b.audit || s.edits || m.edit,
        'lines': b.lines || s.lines || CASE m.edit
            WHEN 'K' THEN chr(10) || r.role || ':' || r.text
            WHEN 'R' THEN chr(10) || CASE m.then_ WHEN 'u' THEN 'user:' ELSE 'assistant:' END
                          || r.text ELSE '' END}})) AS c
    FROM best b JOIN judged r ON r.g = b.g AND r.i = b.i + 1
    JOIN inserts s ON s.place = b.place JOIN moves m ON m.place = s.then_
    WHERE CASE m.edit WHEN 'K' THEN NOT r.is_blank AND NOT r.is_again AND r.role[1] = m.then_
                      WHEN 'R' THEN NOT r.is_blank AND NOT r.is_again ELSE true END
    GROUP BY b.g, r.i, m.then_)),
ended AS (
  SELECT b.g, arg_min({{'cost': b.cost + s.cost, 'audit': b.audit || s.edits,
                       'lines': b.lines || s.lines}},
                      lpad((b.cost + s.cost)::VARCHAR, 12, '0') || b.audit || s.edits) AS x
  FROM best b LEFT JOIN counts c ON c.g = b.g JOIN inserts s ON s.place = b.place
  WHERE b.i = coalesce(c.n, 0) AND s.then_ IN ('', 'a') GROUP BY b.g)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, x.cost::BIGINT AS cost, x.audit AS audit,
       sha256(x.lines[2:]) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM named) k JOIN ended USING (g) LEFT JOIN counts USING (g)
"""

CHECKS: dict[str, str] = {"op9_quality": QUALITY, "op12_merkle": MERKLE,
                          "op13_conversations": CONVERSATIONS}

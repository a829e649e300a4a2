"""DuckDB SQL for the conversation operators (12 and 13); small tables, as it lists every prefix and edit."""

from __future__ import annotations


def crc32(text: str) -> str:
    """crc32 of an ASCII string expression, bit by bit."""
    step = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(range(1, length({text}) + 1), lambda k: ascii(substr({text}, k::INT, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"


WORDS = r"[^\x20\x09-\x0D]+"

TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS b, {crc32('c::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
rows_of AS (SELECT i.c, 0 AS part, t.pos, t.r, t.x FROM ids i JOIN t ON t.c = i.b WHERE t.pos < i.h
            UNION ALL SELECT t.c, 1, t.pos, t.r, t.x FROM t JOIN ids i ON i.c = t.c WHERE t.pos >= i.h),
lists AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY part, pos) AS s FROM rows_of GROUP BY c),
seqs AS (SELECT i.c, coalesce(l.s, []) AS s FROM ids i LEFT JOIN lists l ON l.c = i.c),
pre AS (SELECT c, d, s[1:d] AS k, d = len(s) AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n,
                 coalesce(sha256(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends)), sha256('')) AS ends FROM pre GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
own AS (SELECT n.d, n.k, n.conv_id, n.n, n.ends, coalesce(kids.n, 0) AS n_children,
               CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(n.k[n.d].x, '{WORDS}')) END AS saved
        FROM nodes n LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k),
up AS (SELECT a.d, a.k[1:a.d] AS k, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved
       FROM (SELECT k, n_children, saved, unnest(range(0, d + 1)) AS d FROM own) a GROUP BY 1, 2)
SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, up.n_leaves::BIGINT AS n_leaves,
       up.saved::BIGINT AS saved_tokens, o.ends AS ends_sha256
FROM own o JOIN up ON up.d = o.d AND up.k = o.k LEFT JOIN own p ON p.d = o.d - 1 AND p.k = o.k[1:o.d - 1]
"""

_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_BLANKS = r"[\x20\x09-\x0D]"

REPAIR = f"""
WITH RECURSIVE d AS (SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_KEY)} % 20 AS f FROM conversations),
hit AS (SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos FROM hit),
r AS (SELECT c, turn, role, text, pos, left(role, 1) AS ini,
             CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
                  WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 2
                  WHEN right(regexp_replace(text, '{_BLANKS}+$', ''), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
      FROM placed),
n AS (SELECT c, max(pos) AS n FROM r GROUP BY c),
follows(s, k, st, pre) AS (VALUES (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
                             (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
                             (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
                             (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])),
edit(e, st, ini, dest, role) AS (VALUES ('D', 0, NULL, 0, NULL), ('D', 1, NULL, 1, NULL), ('D', 2, NULL, 2, NULL), ('D', 3, NULL, 3, NULL),
  ('K', 0, 's', 1, NULL), ('K', 0, 'u', 2, NULL), ('K', 1, 'u', 2, NULL), ('K', 2, 'a', 3, NULL), ('K', 3, 'u', 2, NULL),
  ('R', 0, NULL, 2, 'user'), ('R', 1, NULL, 2, 'user'), ('R', 2, NULL, 3, 'assistant'), ('R', 3, NULL, 2, 'user')),
moves AS (SELECT f.s, f.k, f.pre, e.e, e.ini, e.dest, e.role, repeat('I', f.k) || e.e AS word FROM follows f JOIN edit e ON e.st = f.st),
best AS (
  SELECT n.c, n.n AS i, s, {{'cost': cost, 'audit': audit, 'out': fin}} AS b
  FROM n, (VALUES (0, 0, '', []::VARCHAR[]), (1, 10, 'II', ['user:', 'assistant:']), (2, 5, 'I', ['assistant:']), (3, 0, '', [])) v(s, cost, audit, fin)
  UNION ALL
  SELECT b.c, b.i - 1, m.s, min({{'cost': b.b.cost + 5 * m.k + CASE m.e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                                      + CASE WHEN r.fault = 3 AND m.e <> 'D' THEN 5 ELSE 0 END,
                               'audit': m.word || b.b.audit,
                               'out': list_concat(list_concat(m.pre, CASE m.e WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text]
                                                                    ELSE [m.role || ':' || r.text] END), b.b.out)}})
  FROM best b JOIN r ON r.c IS NOT DISTINCT FROM b.c AND r.pos = b.i
       JOIN moves m ON m.dest = b.s AND (m.e = 'D' OR r.fault NOT IN (1, 2)) AND (m.e <> 'K' OR m.ini = r.ini)
  GROUP BY b.c, b.i, m.s),
solved AS (SELECT c, b FROM best WHERE i = 0 AND s = 0),
pairs AS (SELECT c, count(*) AS illegal FROM (SELECT c, lag(ini) OVER (PARTITION BY c ORDER BY pos) || ini AS two FROM r)
          WHERE two NOT IN ('su', 'ua', 'au') GROUP BY c),
tell AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM r GROUP BY c)
SELECT o.conv_id, coalesce(t.gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate,
       coalesce(t.truncated, 0) AS truncated, coalesce(p.illegal, 0) AS illegal, coalesce(s.b.cost, 0)::BIGINT AS cost,
       coalesce(s.b.audit, '') AS audit, sha256(coalesce(array_to_string(s.b.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN tell t ON t.c IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN pairs p ON p.c IS NOT DISTINCT FROM o.conv_id LEFT JOIN solved s ON s.c IS NOT DISTINCT FROM o.conv_id
"""

"""DuckDB SQL of the queries that SQL can express."""

# Words are runs of bytes other than ASCII white space; only A-Z are lower-cased.
NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words),
classes AS (SELECT min(doc_id) AS c, list_sort(g) AS g, len(g) AS n FROM grams WHERE len(g) > 0 GROUP BY list_sort(g), len(g)),
tokens AS (SELECT c, n, unnest(g) AS t FROM classes),
counts AS (SELECT t, count(*) AS df FROM tokens GROUP BY t),
shared AS (SELECT c, n, tokens.t FROM tokens JOIN counts USING (t) WHERE df > 1),
met AS (
  SELECT a.c AS a, b.c AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM shared a JOIN shared b ON a.t = b.t AND a.c < b.c AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met WHERE 100 * common >= 75 * (na + nb - common)
  UNION ALL SELECT b, a FROM met WHERE 100 * common >= 75 * (na + nb - common)),
reach(node, root) AS (
  SELECT c, c FROM classes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node AND r.root < l.b),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, coalesce(comp.root, g.doc_id) AS component_id
FROM grams g LEFT JOIN classes c ON len(g.g) > 0 AND list_sort(g.g) = c.g LEFT JOIN comp ON comp.node = c.c
"""

# Terms are runs of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased.
DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
      FROM groups g JOIN kept k ON g.lang = k.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gp AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p
       FROM m WINDOW w AS (PARTITION BY lang, source)),
lt AS (SELECT lang, term, sum(n) AS n FROM m GROUP BY lang, term),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p
       FROM lt WINDOW w AS (PARTITION BY lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT g.lang, g.source, 'term' AS part, g.term AS item,
            CAST(((g.p - l.p) * (g.p - l.p)) // l.p AS BIGINT) AS value
          FROM gp g JOIN lp l ON g.lang = l.lang AND g.term = l.term WHERE g.n > 0 AND g.p > l.p),
every AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""


def _repair_sql() -> str:
    """Forward dynamic programming over the rows: per state the cheapest edits, then the ASCII-least."""
    line = "CASE WHEN {0}.t IS NULL THEN {1} ELSE {0}.t || chr(10) || {1} END"

    def step(state: str, letter: str, cost: str, text: str | None) -> str:
        new = f"{state}.t" if text is None else line.format(state, text)
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {new}}} END"

    def insert(state: str, role: str) -> str:
        return step(state, "I", "5", f"'{role}:'")

    user = ", ".join(insert(f"st[{k}]", "user") for k in (1, 2, 4))
    def opened(source: str) -> str:
        """The states with the inserts that may come before the next row."""
        return f"""SELECT *, list_min([st[4], {insert('u', 'assistant')}]) AS a
      FROM (SELECT *, st[1] AS z, st[2] AS s, list_min([st[3], {user}]) AS u FROM {source})"""

    keep, role, extra = "role || ':' || text", "fault IN ('', 't')", "CASE WHEN fault = 't' THEN 5 ELSE 0 END"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN {role} AND initial = '{initial}' THEN {step(state, 'K', extra, keep)} END"

    def reroled(state: str, to: str) -> str:
        return f"CASE WHEN {role} THEN {step(state, 'R', f'1 + {extra}', chr(39) + to + ':' + chr(39) + ' || text')} END"

    def dropped(state: str) -> str:
        return step(state, "D", "2", None)

    to_user = ", ".join([dropped("u"), *[kept(q, "u") for q in "zsa"], *[reroled(q, "user") for q in "zsa"]])
    return rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
summed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS fault FROM named),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM summed WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged),
rows AS (SELECT conv_id, turn, role, text, pos, substr(role, 1, 1) AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
      WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 't'
      ELSE '' END AS fault FROM placed),
counted AS (SELECT conv_id, count(*) AS n,
    CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
walk(conv_id, pos, st) AS (
  SELECT conv_id, 0::BIGINT, [{{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}}, NULL, NULL, NULL] FROM counted
  UNION ALL
  SELECT conv_id, pos, [{dropped('z')}, list_min([{dropped('s')}, {kept('z', 's')}]), list_min([{to_user}]),
    list_min([{dropped('a')}, {kept('u', 'a')}, {reroled('u', 'assistant')}])]
  FROM ({opened("(SELECT w.conv_id, r.pos, w.st, r.role, r.text, r.initial, r.fault FROM walk w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.pos = w.pos + 1)")})),
ended AS (SELECT c.*, e.best FROM counted c JOIN (
    SELECT conv_id, pos, list_min([z, a]) AS best FROM ({opened("walk")})) e
  ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND e.pos = c.n)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN ended e ON i.conv_id IS NOT DISTINCT FROM e.conv_id
"""


CONVERSATION_REPAIR = _repair_sql()

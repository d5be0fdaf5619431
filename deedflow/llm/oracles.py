"""SQL for the repair of conversations and the grouping of spelling variants."""

from __future__ import annotations

from deedflow.llm import spelling

# CRC-32 by bytes: ``t`` is the table of all bytes, made by its rule.
_TABLE = """tab AS (
  SELECT [list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    FOR b IN range(256)] AS t
)"""


def _crc(text: str) -> str:
    """Checksum of a text of code points up to U+00FF."""
    points = f"[unicode(ch) FOR ch IN string_split({text}, '')]"
    octets = f"flatten([CASE WHEN u < 128 THEN [u::BIGINT] ELSE [(192 + (u >> 6))::BIGINT, (128 + (u & 63))::BIGINT] END FOR u IN {points}])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"


def _way(state: str, cost: str, edits: str, *lines: str) -> str:
    left = f"{state}.t"
    for line in lines:
        left = f"list_append({left}, {line})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}', 't': {left}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_USER, _ASSISTANT = "'user:'", "'assistant:'"
# States with messages inserted before the next one.
_OPENED = f"""s0, s1,
    {_least("s2", *[_way(s, "2", "I", _USER) for s in ("s0", "s1", "s3")])} AS j2,
    {_least("s3", _way("s2", "2", "I", _ASSISTANT), *[_way(s, "4", "II", _USER, _ASSISTANT) for s in ("s0", "s1")])} AS j3"""


def _edited(state: str, initial: str, given: str) -> list[str]:
    return [
        f"CASE WHEN fault < 2 AND initial = '{initial}' THEN {_way(state, 'fault', 'K', 'line')} END",
        f"CASE WHEN fault < 2 THEN {_way(state, '2 + fault', 'R', f'{given} || text')} END",
    ]


def _from_user_due() -> list[str]:
    return [way for state in ("s0", "s1", "j3") for way in _edited(state, "u", _USER)]


CONVERSATIONS = f"""
WITH RECURSIVE {_TABLE}, dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, tab
), kept AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    left(role, 1) AS initial, role || ':' || text AS line
  FROM kept
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'fine' END AS kind,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
), messages AS (
  SELECT *, CASE kind WHEN 'fine' THEN 0 WHEN 'truncated' THEN 1 ELSE 2 END AS fault FROM judged
), counted AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
    count(*) FILTER (kind = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM messages GROUP BY conv_id
), begun AS (
  SELECT {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS s
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, s AS s0, CASE WHEN n < 0 THEN s END AS s1, CASE WHEN n < 0 THEN s END AS s2, CASE WHEN n < 0 THEN s END AS s3
  FROM counted, begun
  UNION ALL
  SELECT conv_id, i, {_way("s0", "3", "D")},
    {_least(_way("s1", "3", "D"), f"CASE WHEN fault < 2 AND initial = 's' THEN {_way('s0', 'fault', 'K', 'line')} END")},
    {_least(_way("j2", "3", "D"), *_from_user_due())},
    {_least(_way("j3", "3", "D"), *_edited("j2", "a", _ASSISTANT))}
  FROM (
    SELECT m.conv_id, m.i, m.fault, m.initial, m.line, m.text, {_OPENED}
    FROM ways JOIN messages AS m ON m.conv_id IS NOT DISTINCT FROM ways.conv_id AND m.i = ways.i + 1
  )
), ends AS (
  SELECT conv_id, {_least("s0", "j3")} AS best FROM (
    SELECT ways.conv_id, {_OPENED} FROM ways JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ways.conv_id AND i = n
  )
), all_ids AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT all_ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM all_ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM all_ids.conv_id
  LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM all_ids.conv_id
"""

SPELLING = f"""
WITH RECURSIVE {_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents
), hashed AS (
  SELECT run, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, tab WHERE length(run) >= {spelling.LEAST_LETTERS}
), cut AS (
  SELECT CASE WHEN h % {spelling.DAMAGED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM cut WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING count(*) >= {spelling.LEAST_COPIES}
), less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word)::INT + 1))::INT AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, words.word, words.n FROM less JOIN words ON words.word = less.rest
  UNION SELECT words.word, less.word, less.n FROM less JOIN words ON words.word = less.rest
), best AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS top FROM near GROUP BY word
), formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -top.less >= {spelling.RATIO} * words.n THEN top.other END AS form,
    CASE WHEN -top.less >= {spelling.RATIO} * words.n THEN (-top.less)::BIGINT END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, form AS following FROM formed
  UNION ALL
  SELECT chains.word, formed.word, formed.form FROM chains JOIN formed ON formed.word = chains.following
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM chains WHERE following IS NULL) USING (word)
"""

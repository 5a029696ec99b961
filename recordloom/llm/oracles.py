"""SQL (DuckDB) for the queries that it can express, over whole tables."""

from __future__ import annotations

from recordloom.llm import line_templates, repetition

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
least AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + o AS i
  FROM (SELECT doc_id, i, unnest(range(0, 13)) AS o FROM windows JOIN least USING (k) WHERE doc_id > least)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


def _coverage(n: int) -> str:
    """Characters in later occurrences of n-grams, by document."""
    return f"""
grams_{n} AS (
  SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d)),
first_{n} AS (SELECT doc_id, gram, min(i) AS i FROM grams_{n} GROUP BY doc_id, gram HAVING count(*) > 1),
covered_{n} AS (
  SELECT doc_id, sum(length(word)) AS chars FROM words JOIN (
    SELECT DISTINCT doc_id, i + o AS i FROM (
      SELECT g.doc_id, g.i, unnest(range(0, {n})) AS o
      FROM grams_{n} g JOIN first_{n} f ON g.doc_id = f.doc_id AND g.gram = f.gram AND g.i > f.i))
  USING (doc_id, i) GROUP BY doc_id)"""


_SHARES = {n: f"coalesce(covered_{n}.chars, 0) / greatest(b.word_chars, 1)" for n in repetition.COVERAGE}
_WITHIN = " AND ".join(f"share_{n} <= {most}" for n, most in repetition.COVERAGE.items())

REPETITION = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
{", ".join(_coverage(n) for n in repetition.COVERAGE)},
repeated AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM (SELECT g.doc_id, g.i, unnest(range(0, 5)) AS o
        FROM grams_5 g JOIN first_5 f ON g.doc_id = f.doc_id AND g.gram = f.gram)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) AS nth
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(0, len(string_split(text, chr(10))))) AS place FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
again AS (
  SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS chars
  FROM lines WHERE nth > 1 GROUP BY doc_id),
b AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
  FROM d),
measured AS (
  SELECT b.*, coalesce(again.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
         (coalesce(again.chars, 0) / greatest(b.word_chars, 1))::DOUBLE AS line_share,
         {", ".join(f"({share})::DOUBLE AS share_{n}" for n, share in _SHARES.items())}
  FROM b LEFT JOIN again USING (doc_id) LEFT JOIN repeated USING (doc_id)
  {" ".join(f"LEFT JOIN covered_{n} USING (doc_id)" for n in repetition.COVERAGE)}),
judged AS (
  SELECT *, n_words < {repetition.LEAST_WORDS}
         OR 100 * n_repeat_words > {repetition.REPEAT_PERCENT} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND line_share <= {repetition.LINE_COVERAGE} AND {_WITHIN} AS kept FROM judged
"""

_MASKED = (
    "regexp_replace(trim(regexp_replace(line, '[\\x09-\\x0D ]+', ' ', 'g'), ' '), "
    f"'[^ ]*[0-9][^ ]*', '{line_templates.VARIABLE}', 'g')"
)

LINES = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT *, string_split(masked, ' ') AS t FROM (
    SELECT doc_id, place, line, {_MASKED} AS masked
    FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS place FROM d))),
filled AS (
  SELECT doc_id, place, masked, t, len(t) AS size, array_to_string(t[1:{line_templates.DEPTH}], ' ') AS lead
  FROM lines WHERE masked <> ''),
bodies AS (
  SELECT size, lead, masked, any_value(t) AS t, count(DISTINCT doc_id) AS documents
  FROM filled GROUP BY size, lead, masked),
heads AS (
  SELECT size, lead, first(t ORDER BY documents DESC, masked) AS head, first(masked ORDER BY documents DESC, masked) AS name
  FROM bodies GROUP BY size, lead),
named AS (
  SELECT size, lead, masked,
         CASE WHEN len(list_filter(range(1, size + 1), lambda k: t[k] = head[k])) >= size * {line_templates.SIMILAR}
              THEN 'head ' || name ELSE 'own ' || masked END AS template
  FROM bodies JOIN heads USING (size, lead)),
placed AS (
  SELECT doc_id, place, size, lead, template FROM filled JOIN named USING (size, lead, masked)),
recurring AS (
  SELECT size, lead, template, min(doc_id) AS keeper FROM placed GROUP BY size, lead, template
  HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCUMENTS}),
dropped AS (
  SELECT doc_id, list(place) AS places FROM placed JOIN recurring USING (size, lead, template)
  WHERE doc_id <> keeper GROUP BY doc_id)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(places), 0)::BIGINT AS n_dropped,
       CASE WHEN places IS NULL THEN text
            ELSE coalesce(array_to_string(list_transform(
                   list_filter(range(1, len(lines) + 1), lambda k: NOT list_contains(places, k - 1)),
                   lambda k: lines[k]), chr(10)), '') END AS text
FROM d LEFT JOIN dropped USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS vec_id,
         list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n
    ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
WHERE rank <= 3
"""


def _least(*edits: str) -> str:
    return f"list_min([{', '.join(edits)}])"


def _edit(letter: str, cost: str, rest: str, said: str = "") -> str:
    """One edit before the rest: cost, audit, and what is said; structs compare field by field."""
    spoken = f"list_prepend({said}, {rest}.r)" if said else f"{rest}.r"
    return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 'r': {spoken}}}"


def _row(state: str, follows: str, role: str) -> str:
    """What can be done with a row after ``state``, where the turn ``follows`` is next."""
    kept = [(follows, role[0])] + ([("system", "s")] if state == "start" else [])
    keeps = (f"CASE WHEN NOT gone AND left(role, 1) = '{x}' THEN {_edit('K', 'extra', to, 'said')} END" for to, x in kept)
    renamed = f"CASE WHEN NOT gone THEN {_edit('R', '3 + extra', follows, f"'{role}:' || text")} END"
    return _least(_edit("D", "4", state), *keeps, renamed)


_AFTER_USER = _least("b_user", _edit("I", "3", "b_assistant", "'assistant:'"))
_AFTER_ASSISTANT = _least("b_assistant", _edit("I", "3", "b_user", "'user:'"))

# The best continuation from each state, from the last row of a conversation to the first.
CONVERSATIONS = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT),
                lambda c, b: list_reduce(range(8), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
                4294967295::BIGINT), 4294967295) % 20 AS fate
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged),
faulty AS (
  SELECT *, role || ':' || text AS said,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM ordered),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
best AS (
  SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS start,
         {{'c': 6::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS system,
         {{'c': 3::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS user,
         {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS assistant
  FROM counted
  UNION ALL
  SELECT conv_id, i, {_least("b_start", _edit("I", "3", "a_user", "'user:'"))},
         {_least("b_system", _edit("I", "3", "a_user", "'user:'"))}, a_user, {_AFTER_ASSISTANT}
  FROM (
    SELECT *, {_AFTER_USER} AS a_user FROM (
      SELECT conv_id, i, {_row("start", "user", "user")} AS b_start, {_row("system", "user", "user")} AS b_system,
             {_row("user", "assistant", "assistant")} AS b_user, {_row("assistant", "user", "user")} AS b_assistant
      FROM (
        SELECT f.conv_id, f.i, f.role, f.text, f.said, start, system, user, assistant,
               coalesce(f.fault IN ('blank', 'duplicate'), FALSE) AS gone,
               CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS extra
        FROM best JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM best.conv_id AND f.i = best.i - 1)))),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(start.c, 0)::BIGINT AS cost, coalesce(start.a, '') AS audit,
       sha256(coalesce(array_to_string(start.r, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN (SELECT * FROM best WHERE i = 1) b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

ORACLES = {
    "op3_exact_top_k": TOP_K,
    "op4_substring_dedup": SUBSTRINGS,
    "op6_repetition": REPETITION,
    "op7_line_templates": LINES,
    "op11_conversations": CONVERSATIONS,
    "op13_hard_negatives": HARD_NEGATIVES,
}

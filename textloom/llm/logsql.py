"""SQL that reads the message log as the turn operators do; a WITH list that other SQL continues."""

# white space as the rules have it, in RE2 syntax
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
LOG = rf"""
ev AS (
  SELECT trim(regexp_replace(conversation_id, '[\x00\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g')) AS cid,
         regexp_replace(turn_index, '^{_WS}+|{_WS}+$', '', 'g') AS t0,
         lower(regexp_replace(coalesce(role, ''), '^{_WS}+|{_WS}+$', '', 'g')) AS role,
         regexp_replace(coalesce(content, ''), '^{_WS}+|{_WS}+$', '', 'g') AS content
  FROM messages),
msgs AS (
  SELECT DISTINCT cid, CASE WHEN regexp_full_match(t0, '[+-]?[0-9]+') THEN try_cast(t0 AS bigint) END AS turn, role, content
  FROM ev WHERE cid <> ''),
ordered AS (
  SELECT *, row_number() OVER w AS k, lead(role) OVER w AS nxt
  FROM msgs WHERE content <> '' WINDOW w AS (PARTITION BY cid ORDER BY turn)),
shape AS (
  SELECT cid, bool_or(turn IS NULL) OR count(*) <> count(DISTINCT turn) OR max(turn) - min(turn) + 1 <> count(DISTINCT turn) AS broken
  FROM msgs GROUP BY cid),
said AS (
  SELECT cid, bool_or(role NOT IN ('system', 'user', 'assistant')) OR bool_or(role = 'system' AND k > 1)
      OR NOT bool_or(role = 'user') OR NOT bool_or(role = 'assistant')
      OR bool_or(role = 'user' AND coalesce(nxt, '') NOT IN ('user', 'assistant')) AS broken
  FROM ordered GROUP BY cid),
judged AS (
  SELECT shape.cid, shape.broken OR coalesce(said.broken, true) AS dropped FROM shape LEFT JOIN said USING (cid))
"""

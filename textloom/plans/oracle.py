"""SQL of the preparation and evaluation queries, for DuckDB over the same tables."""

from __future__ import annotations

from textloom.plans.reference import DIMS, THRESHOLD

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WS0 = r"[\s\x00\x0b\x1c-\x1f\x{85}\p{Z}]"
SEP = "chr(30)"


def vis(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def low(c: str) -> str:
    # final sigma and dotted capital I as full case mapping has them
    return rf"lower(replace(regexp_replace({c}, '(\p{{L}})Σ(\P{{L}}|$)', '\1ς\2', 'g'), 'İ', 'i̇'))"


def label(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS0}+', ' ', 'g'))"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sents(c: str) -> str:
    return rf"list_filter(string_split(regexp_replace({vis(c)}, '([.!?]) ', concat('\1', {SEP}), 'g'), {SEP}), lambda x: x <> '')"


def words(c: str) -> str:
    return rf"list_distinct(regexp_extract_all({low(c)}, '[\p{{L}}\p{{N}}_]+'))"


# ---------------------------------------------------------------- pairs

PAIRS = f"""
raw AS (
  SELECT pair_row AS _row, {vis("coalesce(query, '')")} AS query, {vis("coalesce(positive, '')")} AS positive FROM pairs),
nonempty AS (SELECT * FROM raw WHERE query <> '' AND positive <> ''),
sent AS (SELECT _row, generate_subscripts(s, 1) AS pos, unnest(s) AS s FROM (SELECT _row, {sents("positive")} AS s FROM nonempty)),
freq AS (SELECT {low("s")} AS sentence, count(DISTINCT _row) AS rows FROM sent GROUP BY 1),
kept AS (
  SELECT _row, count(*) AS n, count(*) FILTER (coalesce(rows, 0) < {THRESHOLD}) AS m,
         trim(coalesce(string_agg(s, ' ' ORDER BY pos) FILTER (coalesce(rows, 0) < {THRESHOLD}), '')) AS text
  FROM sent LEFT JOIN freq ON {low("s")} = sentence GROUP BY _row),
stripped AS (
  SELECT n._row, query, n.positive AS positive_original, CASE WHEN coalesce(m, 0) = 0 OR text = '' THEN n.positive ELSE text END AS positive,
         coalesce(m, 0) = 0 AS fell_back, CASE WHEN coalesce(m, 0) = 0 THEN 0 ELSE n - m END AS lost
  FROM nonempty n LEFT JOIN kept USING (_row)),
reported AS (SELECT *, CASE WHEN positive <> positive_original THEN lost ELSE 0 END AS removed FROM stripped),
normed AS (SELECT *, {low("query")} AS query_norm, {low(vis("positive"))} AS positive_norm FROM stripped),
prepared AS MATERIALIZED (
  SELECT *, sha1('0' || chr(0) || query_norm || chr(0) || positive_norm) AS row_uid
  FROM normed QUALIFY row_number() OVER (PARTITION BY query_norm, positive_norm ORDER BY _row) = 1)"""

GROUPS = f"""{PAIRS},
edge AS (SELECT 'q:' || query_norm AS u, 'p:' || positive_norm AS v FROM prepared UNION SELECT 'p:' || positive_norm, 'q:' || query_norm FROM prepared),
reach AS (SELECT u AS node, u AS label FROM edge UNION SELECT e.v, r.label FROM reach r JOIN edge e ON e.u = r.node),
root AS (SELECT node, substr(sha1('0' || chr(0) || min(label)), 1, 20) AS component FROM reach GROUP BY node),
grouped AS MATERIALIZED (SELECT p.*, component FROM prepared p JOIN root ON node = 'q:' || query_norm),
size AS (SELECT component, count(*) AS size, sha1('42' || chr(0) || component) AS h FROM grouped GROUP BY component),
ranked AS (SELECT *, row_number() OVER (ORDER BY h, component) AS k, sum(size) OVER () AS total FROM size),
fold AS (
  SELECT 0::BIGINT AS k, ''::VARCHAR AS component, 0::BIGINT AS size, ''::VARCHAR AS split, 0::DOUBLE AS a, 0::DOUBLE AS b, 0::DOUBLE AS c
  UNION ALL
  SELECT k, component, size, pick, a + CASE WHEN pick = 'train' THEN size ELSE 0 END, b + CASE WHEN pick = 'validation' THEN size ELSE 0 END, c + CASE WHEN pick = 'test' THEN size ELSE 0 END
  FROM (
    SELECT r.k, r.component, r.size, f.a, f.b, f.c,
           CASE WHEN x >= y AND x >= z THEN 'train' WHEN y >= z THEN 'validation' ELSE 'test' END AS pick
    FROM fold f JOIN ranked r ON r.k = f.k + 1,
    LATERAL (SELECT (total * 0.8::DOUBLE - f.a) / greatest(total * 0.8::DOUBLE, 1) AS x, (total * 0.1::DOUBLE - f.b) / greatest(total * 0.1::DOUBLE, 1) AS y, (total * 0.1::DOUBLE - f.c) / greatest(total * 0.1::DOUBLE, 1) AS z))),
dealt AS (SELECT component, size, split FROM fold WHERE k > 0),
assigned AS (SELECT g.*, split FROM grouped g JOIN dealt USING (component))"""

NAMED = "(SELECT * FROM (VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) AS s(split_a, split_b))"

BUNDLE = f"""{GROUPS},
q0 AS (
  SELECT query_norm, arg_min(query, _row) AS query FROM assigned WHERE split = 'validation' GROUP BY query_norm),
q AS (SELECT *, row_number() OVER (ORDER BY sha1('42' || chr(0) || query_norm), query_norm) - 1 AS k FROM q0 QUALIFY k < 200),
need AS (SELECT a.*, k FROM assigned a JOIN q USING (query_norm) WHERE split = 'validation'),
required AS (SELECT positive_norm, min((k, _row)) AS seat, arg_max(positive, (k, _row)) AS positive FROM need GROUP BY positive_norm),
rest AS (
  SELECT positive_norm, arg_min(positive, _row) AS positive FROM assigned WHERE positive_norm NOT IN (SELECT positive_norm FROM required) GROUP BY positive_norm),
pool AS (
  SELECT positive_norm, positive, row_number() OVER (ORDER BY seat) AS o FROM required
  UNION ALL
  SELECT positive_norm, positive, (SELECT count(*) FROM required) + row_number() OVER (ORDER BY sha1('49' || chr(0) || positive_norm), positive_norm) FROM rest),
corpus AS (SELECT positive_norm, positive, o - 1 AS j FROM pool WHERE o <= 1000),
rel AS (SELECT DISTINCT k, j FROM need JOIN corpus USING (positive_norm))"""

# ---------------------------------------------------------------- conversations

_short = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def json_string(c: str) -> str:
    out = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    for k in range(1, 0x20):
        out = f"replace({out}, chr({k}), '{_short.get(chr(k), f'\\u{k:04x}')}')"
    return f"'\"' || {out} || '\"'"


OPEN, CLOSE, THINK = "<|im_start|>", "'<|im_end|>' || chr(10)", "'<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)"

CHAT = f"""
clean AS (SELECT * FROM (
  SELECT msg_id AS _row, {label("coalesce(conversation_id, '')")} AS cid,
         CASE WHEN regexp_full_match({strip("turn_index")}, '[+-]?[0-9]+') THEN try_cast({strip("turn_index")} AS INT) END AS turn,
         {low(label("coalesce(role, '')"))} AS role, {strip("coalesce(content, '')")} AS content, {label("coalesce(language, '')")} AS language
  FROM messages) WHERE cid <> '' AND content <> ''),
flags AS (
  SELECT cid, bool_or(turn IS NULL) AS bad_turn, bool_or(role NOT IN ('system', 'user', 'assistant')) AS bad_role, count(turn) <> count(DISTINCT turn) AS duplicate_turn,
         NOT (bool_or(role = 'user') AND bool_or(role = 'assistant')) AS missing_role, coalesce(max(turn) FILTER (role = 'system') > min(turn), false) AS late_system
  FROM clean GROUP BY cid),
sound AS (SELECT cid FROM flags WHERE NOT (bad_turn OR bad_role OR duplicate_turn OR missing_role OR late_system)),
msgs AS (SELECT clean.* FROM clean JOIN sound USING (cid)),
conv AS (
  SELECT cid, min(_row) AS first_row, count(*) AS n_messages, coalesce(array_to_string(list_sort(list(DISTINCT language) FILTER (language <> '')), ','), '') AS language,
         sha256('0' || chr(0) || '[' || string_agg('{{"content": ' || {json_string("content")} || ', "role": ' || {json_string("role")} || '}}', ', ' ORDER BY turn) || ']') AS digest
  FROM msgs GROUP BY cid),
uniq AS (SELECT * FROM conv QUALIFY row_number() OVER (PARTITION BY digest ORDER BY first_row, cid) = 1),
parts AS (
  SELECT *, '{OPEN}' || role || chr(10) || CASE WHEN role = 'assistant' THEN {THINK} ELSE '' END AS head FROM msgs),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(content) + length({CLOSE})) OVER (PARTITION BY cid ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a
  FROM parts),
whole AS (SELECT cid, string_agg(head || content || {CLOSE}, '' ORDER BY turn) AS text, max(turn) AS last FROM parts GROUP BY cid)"""


CONV_SPLIT = f"""{CHAT},
sizes AS (SELECT count(*) AS n, greatest(1, round_even(count(*) * 0.8, 0))::BIGINT AS tr, greatest(1, round_even(count(*) * 0.1, 0))::BIGINT AS va FROM uniq),
placed2 AS (SELECT cid, row_number() OVER (ORDER BY sha256('42' || chr(0) || digest), digest) AS position FROM uniq),
placed3 AS (
  SELECT cid, position, CASE WHEN position <= CASE WHEN tr + va >= n THEN greatest(1, n - 2) ELSE tr END THEN 'train'
    WHEN position <= CASE WHEN tr + va >= n THEN greatest(1, n - 2) + 1 ELSE tr + va END THEN 'validation' ELSE 'test' END AS split FROM placed2, sizes)"""


def code_sum(c: str) -> str:
    return f"coalesce(list_sum(list_transform(regexp_extract_all({c}, '(?s).'), lambda x: unicode(x))), 0)::BIGINT"


LABELS = f"""{CHAT},
lab AS (SELECT cid, sum(length(content)) AS n, sum({code_sum("content")}) AS s FROM msgs WHERE role = 'assistant' GROUP BY cid),
labels AS (
  SELECT cid, length(text) AS n_tokens, {code_sum("text")} AS sum_ids, lab.n::BIGINT AS n_labels, (lab.s - 100 * (length(text) - lab.n))::BIGINT AS sum_labels
  FROM whole JOIN lab USING (cid))"""

# ---------------------------------------------------------------- vectors

_cut = " UNION ALL ".join(f"SELECT {n} AS dim, vec_id, label, list_transform(x, lambda v: v / greatest(sqrt(list_dot_product(x, x)), 1e-12)) AS v FROM (SELECT vec_id, label, embedding[1:{n}]::DOUBLE[] AS x FROM embeddings)" for n in DIMS)
VECTORS = f"""
cut AS ({_cut}),
full_ AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
near AS (
  SELECT q.vec_id AS qid, c.vec_id AS did, list_dot_product(q.v, c.v) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM full_ q JOIN full_ c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
top AS (
  SELECT q.dim, q.vec_id AS qid, c.vec_id AS did, list_dot_product(q.v, c.v) AS score, row_number() OVER (PARTITION BY q.dim, q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM cut q JOIN cut c ON q.dim = c.dim AND q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id QUALIFY rank <= 100),
rel AS (SELECT qid, did FROM top WHERE dim = 64 AND rank <= 3),
hits AS (SELECT t.*, r.did IS NOT NULL AS hit, count(r.did) OVER (PARTITION BY t.dim, t.qid ORDER BY rank) AS seen FROM top t LEFT JOIN rel r USING (qid, did)),
per AS (
  SELECT dim, qid, min(rank) FILTER (hit) AS first_rank, max(score) FILTER (rank = 1) AS top_score, count(*) FILTER (hit AND rank <= 1) AS h1, count(*) FILTER (hit AND rank <= 5) AS h5,
         count(*) FILTER (hit AND rank <= 10) AS h10, coalesce(sum(1 / log2(rank + 1)) FILTER (hit AND rank <= 10), 0) AS dcg, coalesce(sum(seen / rank) FILTER (hit), 0) AS ap
  FROM hits GROUP BY dim, qid),
scored AS (
  SELECT dim, count(*) AS queries, avg((coalesce(first_rank, 99) <= 1)::INT) AS accuracy_1, avg((coalesce(first_rank, 99) <= 5)::INT) AS accuracy_5, avg((coalesce(first_rank, 99) <= 10)::INT) AS accuracy_10,
         avg(h1 / 3) AS recall_1, avg(h5 / 3) AS recall_5, avg(h10 / 3) AS recall_10, avg(coalesce(CASE WHEN first_rank <= 10 THEN 1 / first_rank END, 0)) AS mrr_10,
         avg(dcg / (1 + 1 / log2(3) + 0.5)) AS ndcg_10, avg(h1) AS precision_1, avg(h5 / 5) AS precision_5, avg(h10 / 10) AS precision_10, avg(ap / 3) AS map_100
  FROM per GROUP BY dim)"""

CALIBRATION = f"""{VECTORS},
sorted AS (SELECT dim, top_score AS s, coalesce(first_rank = 1, false) AS ok, row_number() OVER (PARTITION BY dim ORDER BY top_score) - 1 AS p, count(*) OVER (PARTITION BY dim) AS n FROM per),
grid AS (SELECT DISTINCT dim, n, i, ((n - 1) * i) // 200 AS lo, ((n - 1) * i) % 200 AS r FROM sorted, range(0, 201) AS g(i)),
cut_at AS (
  SELECT DISTINCT g.dim, g.n, CASE WHEN r = 0 THEN a.s ELSE a.s + (b.s - a.s) * (r / 200) END AS t
  FROM grid g JOIN sorted a ON a.dim = g.dim AND a.p = lo JOIN sorted b ON b.dim = g.dim AND b.p = lo + (r > 0)::INT),
cal0 AS (
  SELECT c.dim, t AS threshold, count(*) FILTER (ok) / count(*) AS precision, count(*) / any_value(c.n) AS coverage
  FROM cut_at c JOIN sorted s ON s.dim = c.dim AND s.s >= t GROUP BY c.dim, t),
cal AS (SELECT *, CASE WHEN precision + coverage > 0 THEN 2 * precision * coverage / (precision + coverage) ELSE 0 END AS f1 FROM cal0)"""

_IR = ("accuracy_1", "accuracy_5", "accuracy_10", "recall_1", "recall_5", "recall_10", "mrr_10", "ndcg_10")
_round = lambda cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)
_target = " UNION ALL ".join(
    f"SELECT d.dim, 'precision_{p}' AS target, threshold, precision, coverage FROM (SELECT DISTINCT dim FROM cal) d LEFT JOIN (SELECT * FROM cal WHERE precision >= {p / 100} QUALIFY row_number() OVER (PARTITION BY dim ORDER BY coverage DESC, precision DESC, threshold) = 1) USING (dim)"
    for p in (90, 95, 98)
)


def mined(ctes: str, anchors: str, corpus: str, candidates: str, guard: str = "true") -> str:
    """``anchors`` (qid, pos_id, component, pos_score, v, pos_norm), ``corpus`` (did, component, v, norm) and ``candidates`` (qid, did, score, rank) as the rules of mining say."""
    return f"""{ctes},
anchors AS ({anchors}),
corpus AS ({corpus}),
cand AS ({candidates}),
open_ AS MATERIALIZED (
  SELECT a.qid, n.did, n.score, n.rank FROM anchors a JOIN cand n ON n.qid = a.qid AND n.rank <= 16 JOIN corpus c ON c.did = n.did
  WHERE n.did <> a.pos_id AND c.component <> a.component AND n.score <= a.pos_score - 0.02),
hard AS (
  SELECT n.qid, n.did, n.score FROM open_ n JOIN anchors a USING (qid) JOIN corpus c ON c.did = n.did WHERE {guard} QUALIFY row_number() OVER (PARTITION BY n.qid ORDER BY n.rank) = 1),
ring AS (SELECT did, component, v, row_number() OVER (ORDER BY sha1('42' || chr(0) || did), did) - 1 AS place FROM corpus),
draw AS (
  SELECT a.*, j, (('0x' || substr(sha1('42' || chr(0) || a.qid || chr(0) || j), 1, 12))::BIGINT % (SELECT count(*) FROM ring)) AS start
  FROM anchors a, range(0, 4) AS r(j) WHERE a.qid NOT IN (SELECT qid FROM hard)),
led AS (
  SELECT d.qid, d.j, d.pos_id, d.v AS q, r.did, r.v FROM draw d JOIN ring r ON r.component <> d.component
  QUALIFY row_number() OVER (PARTITION BY d.qid, d.j ORDER BY r.place < d.start, r.place) = 1),
drawn AS (SELECT * FROM led WHERE did <> pos_id QUALIFY row_number() OVER (PARTITION BY qid ORDER BY j) = 1),
mined AS (
  SELECT a.qid, did, 'semi_hard' AS mode, a.pos_score - score AS margin FROM hard JOIN anchors a USING (qid)
  UNION ALL SELECT d.qid, d.did, 'random_fallback', a.pos_score - list_dot_product(d.q, d.v) FROM drawn d JOIN anchors a USING (qid))"""


VEC_CORPUS, VEC_NEAR = "SELECT vec_id AS did, label AS component, v, NULL AS norm FROM full_", "SELECT qid, did, score, rank FROM near"
NEAR_ANCHORS = "SELECT n.qid, n.did AS pos_id, n.score AS pos_score, q.label AS component, q.v FROM near n JOIN full_ q ON q.vec_id = n.qid WHERE n.rank = 1"
LABEL_ANCHORS = """SELECT q.vec_id AS qid, q.label AS component, c.vec_id AS pos_id, q.v, list_dot_product(q.v, c.v) AS pos_score
  FROM full_ q JOIN full_ c ON q.label = c.label AND q.vec_id <> c.vec_id AND q.vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY c.vec_id < q.vec_id, c.vec_id) = 1"""

_letters = lambda c: "[" + ", ".join(f"(length({c}) - length(replace({c}, '{x}', '')))::DOUBLE" for x in "abcdefghijklmnopqrstuvwxyz") + "]"
_unit = lambda c: f"list_transform({_letters(c)}, lambda x: x / sqrt(list_dot_product({_letters(c)}, {_letters(c)})))"
_some = lambda c: f"list_sum({_letters(c)}) > 0"
TEXT_MINED = mined(
    f"""{GROUPS},
passages AS MATERIALIZED (SELECT min(_row) AS did, positive_norm AS norm, component, {_unit("positive_norm")} AS v FROM grouped WHERE {_some("positive_norm")} GROUP BY positive_norm, component),
asked AS MATERIALIZED (SELECT g._row AS qid, g.component, p.did AS pos_id, p.norm AS pos_norm, {_unit("query_norm")} AS v, p.v AS w FROM grouped g JOIN passages p ON p.norm = g.positive_norm WHERE {_some("query_norm")})""",
    "SELECT qid, component, pos_id, pos_norm, v, round(list_dot_product(v, w), 6) AS pos_score FROM asked",
    "SELECT did, component, v, norm FROM passages",
    """SELECT a.qid, p.did, round(list_dot_product(a.v, p.v), 6) AS score, row_number() OVER (PARTITION BY a.qid ORDER BY round(list_dot_product(a.v, p.v), 6) DESC, p.did) AS rank FROM asked a, passages p""",
    f"coalesce(len(list_intersect({words('a.pos_norm')}, {words('c.norm')})) / nullif(len(list_distinct(list_concat({words('a.pos_norm')}, {words('c.norm')}))), 0), 0) < 0.88",
)
_MARGINS = "SELECT count(*) AS rows, count(*) FILTER (mode = 'semi_hard') AS semi_hard, count(*) FILTER (mode = 'random_fallback') AS random_fallback, round(avg(margin), 6) AS mean_margin, round(median(margin), 6) AS median_margin FROM mined"


def shared(field: str, rows: str) -> str:
    return f"""SELECT '{field}' AS field, s.split_a, s.split_b, count(v.value) AS shared
FROM {NAMED} s LEFT JOIN (
  SELECT x.split AS a, y.split AS b, x.value FROM (SELECT DISTINCT split, {field} AS value FROM {rows}) x JOIN (SELECT DISTINCT split, {field} AS value FROM {rows}) y ON x.value = y.value AND x.split <> y.split) v
  ON v.a = s.split_a AND v.b = s.split_b GROUP BY ALL"""


def q(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select}"


SQL = {
    "visible_text": f"SELECT doc_id, coalesce(length({vis('text')}), 0) AS n_chars, md5({vis('text')}) AS digest FROM documents",
    "norm_text": f"SELECT doc_id, coalesce(length({low(vis('text'))}), 0) AS n_chars, md5({low(vis('text'))}) AS digest FROM documents",
    "nonempty_docs": f"SELECT doc_id, source FROM documents WHERE coalesce({vis('text')}, '') <> ''",
    "sentences": f"SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, md5(unnest(s)) AS digest FROM (SELECT doc_id, {sents('text')} AS s FROM documents)",
    "run_tokens": "SELECT msg_id, substr(t, 1, 80) AS token, nullif(substr(t, 1, 48), '') AS label FROM (SELECT msg_id, regexp_replace(regexp_replace(conversation_id, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g') AS t FROM messages)",
    "token_jaccard": f"""SELECT pair_row, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END, 9) AS jaccard
FROM (SELECT pair_row, {words('query')} AS a, {words('positive')} AS b FROM pairs)""",
    "boilerplate_freq": q(PAIRS, "SELECT sentence, rows FROM freq"),
    "boilerplate_top25": q(PAIRS, f"SELECT * FROM (SELECT sentence, rows FROM freq ORDER BY rows DESC, sentence LIMIT 25) WHERE rows >= {THRESHOLD}"),
    "boilerplate_strip": q(PAIRS, "SELECT _row, positive, fell_back, removed FROM reported"),
    "boilerplate_report": q(PAIRS, "SELECT count(*) AS rows, count(*) FILTER (positive <> positive_original) AS rows_changed, coalesce(sum(removed), 0)::BIGINT AS sentences_removed, count(*) FILTER (fell_back) AS fallback_rows FROM reported"),
    "stable_hash_sample": q(PAIRS, f"SELECT DISTINCT {low('query')} AS query_norm, sha1('42' || chr(0) || {low('query')}) AS hash FROM nonempty ORDER BY hash, query_norm LIMIT 50"),
    "row_uid": q(PAIRS, f"SELECT _row, sha1('0' || chr(0) || {low('query')} || chr(0) || {low('positive')}) AS row_uid FROM nonempty"),
    "exact_pair_dedup": q(PAIRS, "SELECT _row, query, positive, row_uid FROM prepared"),
    "pair_counts": q(
        PAIRS,
        "SELECT (SELECT count(*) FROM pairs) AS original_rows, (SELECT count(*) FROM nonempty) AS nonempty_rows, count(*) AS rows_after_dedup, (SELECT count(*) FROM nonempty) - count(*) AS exact_pairs_removed, count(DISTINCT query_norm) AS unique_queries, count(DISTINCT positive_norm) AS unique_passages FROM prepared",
    ),
    "training_rows": q(PAIRS, "SELECT row_uid, 'query: ' || query AS anchor, 'passage: ' || positive AS positive FROM prepared"),
    "training_triplets": q(
        TEXT_MINED,
        """, passage AS (SELECT min(_row) AS did, arg_min(positive, _row) AS negative FROM grouped GROUP BY positive_norm)
SELECT row_uid, md5('query: ' || query || chr(30) || 'passage: ' || positive || chr(30) || 'passage: ' || negative) AS digest FROM mined JOIN grouped ON _row = qid JOIN passage USING (did)""",
    ),
    "batch_repeats": q(
        PAIRS,
        """, t AS (SELECT substr(row_uid, 1, 1) AS batch, unnest(['query: ' || query, 'passage: ' || positive]) AS text FROM prepared)
SELECT batch, text, count(*) AS times FROM t GROUP BY ALL HAVING count(*) > 1""",
    ),
    "components": q(GROUPS, "SELECT _row, component FROM grouped"),
    "component_sizes": q(GROUPS, "SELECT component, size FROM size"),
    "component_split": q(GROUPS, "SELECT component, size, split FROM dealt"),
    "component_cap": q(GROUPS, "SELECT component, size FROM (SELECT *, coalesce(sum(size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM ranked) WHERE total <= total // 2 OR prev < total // 2"),
    "split_isolation": q(GROUPS, " UNION ALL ".join(shared(f, "assigned") for f in ("component", "query_norm", "positive_norm"))),
    "conv_rejects": q(CHAT, " UNION ALL ".join(f"SELECT cid AS conversation_id, '{r}' AS reason FROM flags WHERE {r}" for r in ("bad_turn", "bad_role", "duplicate_turn", "missing_role", "late_system"))),
    "conv_messages": q(CHAT, "SELECT cid AS conversation_id, first_row, n_messages, digest FROM conv"),
    "conv_language_set": q(CHAT, "SELECT cid AS conversation_id, language FROM conv"),
    "conv_dedup": q(CHAT, "SELECT cid AS conversation_id, digest FROM uniq"),
    "conv_split": q(CONV_SPLIT, "SELECT cid AS conversation_id, position, split FROM placed3"),
    "conv_split_checked": q(CONV_SPLIT, "SELECT split, count(*) AS conversations FROM placed3 GROUP BY split"),
    "generation_sample": q(
        f"""{CONV_SPLIT},
few AS (SELECT cid FROM placed3 WHERE split = 'validation' ORDER BY position LIMIT 8),
o AS (SELECT *, max(turn) FILTER (role = 'assistant') OVER (PARTITION BY cid) AS upto FROM parts JOIN few USING (cid))""",
        f"""SELECT cid AS conversation_id, md5(coalesce(string_agg(head || content || {CLOSE}, '' ORDER BY turn) FILTER (turn < upto), '') || '{OPEN}assistant' || chr(10) || {THINK}) AS rendered,
  md5(any_value(content) FILTER (turn = upto)) AS expected FROM o GROUP BY cid""",
    ),
    "conv_leakage": q(
        f"""{CHAT},
assigned AS (SELECT DISTINCT cid, split FROM (SELECT {label('conversation_id')} AS cid, {low(label('split_name'))} AS split FROM split_assignments) WHERE split <> ''),
whole_ones AS (SELECT split, digest, cid AS conversation_id FROM conv JOIN assigned USING (cid))""",
        shared("digest", "whole_ones") + " UNION ALL " + shared("conversation_id", "whole_ones"),
    ),
    "assistant_labels": q(LABELS, "SELECT cid AS conversation_id, n_tokens, sum_ids, n_labels, sum_labels FROM labels"),
    "label_truncation": q(
        f"""{CHAT},
cutoff AS (SELECT cid, text, greatest(length(text) - 512, 0) AS c FROM whole),
seen AS (
  SELECT cid, sum(greatest(a + length(content) - greatest(a, c), 0)) AS n, sum({code_sum("substr(content, greatest(c - a, 0)::BIGINT + 1)")}) AS s
  FROM placed JOIN cutoff USING (cid) WHERE role = 'assistant' GROUP BY cid)""",
        f"""SELECT cid AS conversation_id, length(text) - c AS n_tokens, {code_sum("substr(text, c + 1)")} AS sum_ids, seen.n::BIGINT AS n_labels, (seen.s - 100 * (length(text) - c - seen.n))::BIGINT AS sum_labels
FROM cutoff JOIN seen USING (cid) WHERE seen.n > 0""",
    ),
    "collate_padding": q(
        f"{LABELS}, b AS (SELECT *, substr(sha1(cid), 1, 2) AS batch FROM labels), w AS (SELECT *, max(n_tokens) OVER (PARTITION BY batch) AS m FROM b)",
        "SELECT cid AS conversation_id, batch, m AS n_tokens, sum_ids, n_labels, sum_labels - 100 * (m - n_tokens) AS sum_labels, n_tokens AS n_attended FROM w",
    ),
    "generation_prompts": q(
        f"{CHAT}, o AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn) - 1 AS k, lag(content) OVER (PARTITION BY cid ORDER BY turn) AS prev FROM msgs)",
        "SELECT cid AS conversation_id, k AS n_prompt, md5(coalesce(prev, '')) AS last_digest, md5(content) AS expected_digest FROM o WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY cid ORDER BY turn DESC) = 1",
    ),
    "dim_truncate": q(VECTORS, "SELECT vec_id, dim, round(v[1], 6) AS first, round(list_dot_product(v, v), 6) AS length FROM cut"),
    "knn_top10": q(VECTORS, "SELECT qid, rank, did, round(score, 6) AS score FROM near WHERE rank <= 10"),
    "knn_dims": q(VECTORS, "SELECT dim, qid, rank, did, round(score, 6) AS score FROM top WHERE rank <= 10"),
    "ir_metrics": q(VECTORS, f"SELECT queries, {_round(_IR)} FROM scored WHERE dim = 32"),
    "ir_metrics_by_dim": q(VECTORS, f"SELECT dim, queries, {_round(_IR)} FROM scored"),
    "ir_extended": q(VECTORS, f"SELECT dim, {_round(('precision_1', 'precision_5', 'precision_10', 'map_100'))} FROM scored"),
    "calibration": q(CALIBRATION, f"SELECT dim, {_round(('threshold', 'precision', 'coverage', 'f1'))} FROM cal"),
    "calibration_targets": q(
        f"{CALIBRATION}, t AS ({_target} UNION ALL SELECT dim, 'best_f1', threshold, precision, coverage FROM cal QUALIFY row_number() OVER (PARTITION BY dim ORDER BY f1 DESC, threshold) = 1)",
        f"SELECT dim, target, {_round(('threshold', 'precision', 'coverage'))} FROM t",
    ),
    "hard_negatives": q(mined(VECTORS, NEAR_ANCHORS, VEC_CORPUS, VEC_NEAR), "SELECT qid, did, mode, round(margin, 6) AS margin FROM mined"),
    "hard_negatives_fallback": q(mined(VECTORS, LABEL_ANCHORS, VEC_CORPUS, VEC_NEAR), "SELECT qid, did, mode, round(margin, 6) AS margin FROM mined"),
    "hard_negatives_text": q(TEXT_MINED, "SELECT qid, did, mode, round(margin, 6) AS margin FROM mined"),
    "hard_negative_margins": q(mined(VECTORS, NEAR_ANCHORS, VEC_CORPUS, VEC_NEAR), _MARGINS),
    "hard_negative_margins_fallback": q(mined(VECTORS, LABEL_ANCHORS, VEC_CORPUS, VEC_NEAR), _MARGINS),
    "loss_rows": q(GROUPS, "SELECT _row, row_uid FROM assigned WHERE split = 'validation' ORDER BY _row LIMIT 50"),
    "knn_index_recall": "SELECT count(*) * least(10, (SELECT count(*) - 1 FROM embeddings)) AS exact, true AS reached FROM embeddings WHERE vec_id % 100 = 0",
    "eval_queries": q(BUNDLE, "SELECT printf('q%06d', k) AS qid, 'query: ' || query AS text FROM q WHERE k IN (SELECT k FROM rel)"),
    "eval_corpus": q(BUNDLE, "SELECT printf('d%06d', j) AS did, 'passage: ' || positive AS text, positive_norm FROM corpus"),
    "eval_qrels": q(BUNDLE, "SELECT printf('q%06d', k) AS qid, printf('d%06d', j) AS did FROM rel"),
    "select_winner": q(
        VECTORS,
        """, t AS (SELECT 'dim' || dim AS name, ndcg_10 AS s FROM scored WHERE dim <> 64 ORDER BY ndcg_10 DESC, dim DESC LIMIT 1), b AS (SELECT ndcg_10 AS s FROM scored WHERE dim = 64)
SELECT CASE WHEN t.s >= b.s THEN t.name ELSE 'base' END AS winner, round(CASE WHEN t.s >= b.s THEN t.s ELSE b.s END, 6) AS score FROM t, b""",
    ),
    "perplexity": "SELECT label, round(exp(least(avg(1 - embedding[1]::DOUBLE), 20)), 6) AS perplexity FROM embeddings GROUP BY label",
}

"""Queries of the problems tagged llm, and their SQL where whole tables allow one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.llm import budget, conversations, encoding, labels, langid, leaks, overlap, packing, pairs, pii, related
from textloom.llm.logsql import LOG
from textloom.operators import turns
from textloom.plans.oracle import label, strip
from textloom.session import materialize, table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return conversations.dropped(table(spark, d, "messages"))


def p5_conversations(spark: SparkSession, d: str) -> DataFrame:
    out = conversations.rebuilt(table(spark, d, "messages"))
    return out.select("conversation_id", F.size("messages").cast("bigint").alias("n_messages"), F.sha2(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n"), 256).alias("digest"))


def p1_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return budget.message_budget(table(spark, d, "messages"), table(spark, d, "threads"), labels.canonical(F.col("language")))


def p1_slices(spark: SparkSession, d: str) -> DataFrame:
    """The part of the budget that needs no tokenizer: messages and different texts of each slice."""
    return p1_token_budget(spark, d).select("source_name", "language", "domain_code", "messages", "texts")


def _sides(spark: SparkSession, d: str) -> DataFrame:
    """(id, split, side) of the conversations that have a split: 1 training, 2 held out."""
    named = F.lower(T.label(F.col("split_name")))
    side = F.when(named == "train", 1).when(named.isin("validation", "test"), 2)
    return table(spark, d, "split_assignments").select(T.label(F.col("conversation_id")).alias("id"), named.alias("split"), side.alias("side")).filter("id <> '' AND side IS NOT NULL").distinct()


def _records(spark: SparkSession, d: str) -> DataFrame:
    texts = overlap.conversation_texts(table(spark, d, "messages")).withColumnRenamed("conversation_id", "id")
    return texts.join(_sides(spark, d).select("id", "side").distinct(), "id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Conversations of a held-out split with their twin in training."""
    return overlap.cross_split_pairs(_records(spark, d)).select(F.col("id_a").alias("conversation_id_a"), F.col("id_b").alias("conversation_id_b"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Held-out conversations with a twin, per split and source: how many, the mean share of their words under spans shared with any twin, and of their longest common subsequence."""
    each = overlap.coverage(_records(spark, d))
    splits = _sides(spark, d).filter("side = 2").select("id", "split")
    source = table(spark, d, "messages").select(T.label(F.col("conversation_id")).alias("id"), "source_name").groupBy("id").agg(F.min("source_name").alias("source_name"))
    x = splits.join(each, "id").join(source, "id", "left")
    return x.groupBy("split", "source_name").agg(F.count("*").alias("conversations"), F.avg(F.col("covered") / F.col("n")).alias("mean_coverage"), F.avg("share").alias("mean_share"))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row per conversation with a split: its class of near copies, and its number of different twins across the splits."""
    return overlap.classes(_records(spark, d)).select(F.col("id").alias("conversation_id"), "class_id", "twins")


def _profiles(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    """The profile table has a fixed handful of rows; a larger one is refused rather than collected."""
    rows = table(spark, d, "pack_profiles").select("profile_name", "max_chars").dropna().dropDuplicates(["profile_name"]).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 container profiles")
    return sorted((r.profile_name, r.max_chars) for r in rows)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    kept = turns.verdicts(turns.turn_facts(turns.events(table(spark, d, "messages")))).filter("kept")
    return packing.pack(kept.select(F.col("conversation_id").alias("item_id"), F.col("n_chars").alias("size")), _profiles(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Conversations that lie in more than one container once all are packed."""
    return packing.split_items(_packed(spark, d)).select("profile_name", F.col("item_id").alias("conversation_id"))


def p4_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_stats(_packed(spark, d), _profiles(spark, d))


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    """What any packing must hold: conversations, fragments and characters of each profile, and no container over its capacity."""
    packed = materialize(_packed(spark, d), "packed")
    own = F.when(F.col("container") < 0, F.col("item_id"))
    cap = spark.createDataFrame(_profiles(spark, d), "profile_name string, capacity long")
    bins = packed.groupBy("profile_name", "block", "container", own.alias("own")).agg(F.sum("size").alias("used"), F.count("*").alias("fragments"), F.count_if(F.col("fragment") == 0).alias("conversations"))
    return bins.join(cap, "profile_name").groupBy("profile_name").agg(F.sum("conversations").alias("conversations"), F.sum("fragments").alias("fragments"), F.sum("used").alias("chars"), F.count_if(F.col("used") > F.col("capacity")).alias("overfull"))


def _related(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conversation_id, root), the spanning forest, and (conversation_id, split) for the conversations that have one."""
    splits = table(spark, d, "split_assignments").select(T.label(F.col("conversation_id")).alias("conversation_id"), F.lower(T.label(F.col("split_name"))).alias("split")).filter("conversation_id <> '' AND split <> ''").distinct()
    return *related.related_conversations(table(spark, d, "messages"), table(spark, d, "threads"), splits), splits


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with a split whose group has more than one split today."""
    groups, _, splits = _related(spark, d)
    x = groups.join(splits, "conversation_id")
    mixed = x.groupBy("root").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).filter("lo <> hi").select("root")
    return x.join(mixed, "root", "left_semi").select("conversation_id").distinct()


FRACTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    """A new split for every conversation, whole groups together."""
    groups = materialize(_related(spark, d)[0], "groups")
    dealt = related.deal_splits(groups.groupBy("root").agg(F.count("*").alias("size")), FRACTIONS)
    return groups.join(dealt, "root").select("conversation_id", "root", "split")


def p6_forest(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the spanning forest that holds the groups together."""
    return _related(spark, d)[1]


def p6_isolation(spark: SparkSession, d: str) -> DataFrame:
    """What the new splits must keep: all conversations placed once, groups undivided, and every share met up to the largest group or one part in a hundred."""
    x = materialize(p6_splits(spark, d), "splits")
    g = x.groupBy("root").agg(F.count("*").alias("size"), F.countDistinct("split").alias("splits"))
    share = F.create_map(*(F.lit(v) for kv in FRACTIONS.items() for v in kv))
    one = F.lit(1).alias("one")
    total = g.agg(one, F.sum("size").alias("conversations"), F.count("*").alias("groups"), F.count_if(F.col("splits") > 1).alias("divided"), F.max("size").alias("largest"))
    off = x.groupBy("split").agg(one, F.count("*").alias("n")).join(total.select("one", "conversations", "largest"), "one")  # three rows and one
    met = off.agg(one, F.bool_and(F.abs(F.col("n") - share[F.col("split")] * F.col("conversations")) <= F.greatest(F.col("largest"), F.col("conversations") / 100)).alias("shares_met"))
    return total.join(met, "one").select("conversations", "groups", "divided", "shares_met")


def language_model(spark: SparkSession, d: str) -> langid.Model:
    m = table(spark, d, "messages")
    role = F.lower(T.label(F.col("role")))
    labelled = m.select(labels.canonical(F.col("language")).alias("lang_code"), F.col("content").alias("text"), F.when(role.isin("system", "user", "assistant"), role).alias("stratum"))
    return langid.fit(table(spark, d, "lang_samples"), labelled)


def p2_defects(spark: SparkSession, d: str) -> DataFrame:
    """Every triggered defect of every pair."""
    out = pairs.defects(table(spark, d, "messages"), language_model(spark, d))
    return out.select("conversation_id", "turn_index", F.explode("defects").alias("defect"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The first defect of every pair, in the order of the rules: a pair has one at most."""
    out = pairs.defects(table(spark, d, "messages"), language_model(spark, d))
    return out.select("conversation_id", "turn_index", F.element_at("defects", 1).alias("defect"))


def p7_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every message row, with its confidence."""
    out = langid.label_segments(language_model(spark, d), table(spark, d, "messages"), "msg_id", "content", labels.canonical(F.col("language")))
    return out.select(F.col("id").alias("msg_id"), "seg_no", "lang_code", "confidence")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    out = langid.label_segments(language_model(spark, d), table(spark, d, "messages"), "msg_id", "content", labels.canonical(F.col("language")))
    return langid.label_cases(out).select(F.col("id").alias("msg_id"), "seg_no", "lang_code")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    return p9_found(spark, d).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))


def _pii_model(spark: SparkSession, d: str) -> pii.Model:
    return pii.fit(table(spark, d, "documents"), table(spark, d, "known_names"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"), _pii_model(spark, d))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(spark, d, "documents"), _pii_model(spark, d))


_canonical = f"regexp_replace(lower({label('language')}), '[\\s_/+]+', '-', 'g')"
_code = f"CASE WHEN {_canonical} IN ({', '.join(f"'{x}'" for x in labels.MIXED)}) THEN 'ta-en' " + " ".join(f"WHEN split_part({_canonical}, '-', 1) IN ({', '.join(f"'{x}'" for x in names)}) THEN '{code}'" for code, names in labels.NAMES.items()) + " END"
_number = strip("turn_index")
_LENGTHS = f"""{LOG}, long AS (
  SELECT cid, sum(length(content)) AS n FROM msgs JOIN judged USING (cid) WHERE NOT dropped GROUP BY cid)"""
_GROUPS = rf"""
owned AS (
  SELECT DISTINCT {label("conversation_id")} AS id, lower(regexp_replace(account_id, '[^\p{{L}}\p{{N}}]+', '', 'g')) AS acct FROM messages),
splits AS (SELECT DISTINCT id, split FROM (SELECT {label("conversation_id")} AS id, lower({label("split_name")}) AS split FROM split_assignments) WHERE id <> '' AND split <> ''),
ids AS (SELECT id FROM owned UNION SELECT {label("conversation_id")} FROM threads UNION SELECT id FROM splits),
half AS (
  SELECT id AS u, chr(1) || acct AS v FROM owned WHERE id <> '' AND acct NOT IN ({", ".join(f"'{x}'" for x in T.NO_ACCOUNT)})
  UNION SELECT {label("t.conversation_id")}, coalesce(i.id, {label("t.parent_id")}) FROM threads t LEFT JOIN ids i ON lower(i.id) = lower({label("t.parent_id")}) WHERE {label("t.parent_id")} <> ''
  UNION SELECT b.id, a.id FROM ids a JOIN ids b ON starts_with(b.id, a.id) AND length(b.id) > length(a.id) AND NOT regexp_full_match(substr(b.id, length(a.id) + 1, 1), '[\p{{L}}\p{{N}}]') WHERE a.id <> ''),
edge AS (SELECT u, v FROM half UNION SELECT v, u FROM half),
reach AS (SELECT u AS node, u AS root FROM edge UNION SELECT e.v, r.root FROM reach r JOIN edge e ON e.u = r.node),
member AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_token_budget, p1_slices, p2_found, p2_defects, p3_found, p3_report, p3_classes, p4_found, p4_containers, p4_totals, p5_found, p5_conversations,
        p6_found, p6_splits, p6_forest, p6_isolation, p7_found, p7_segments, p8_ids, p9_found, p9_items, p10_found, p10_redacted,
    )
}

ORACLE: dict[str, str] = {
    "p1_slices": f"""WITH rows AS (
  SELECT CASE WHEN coalesce({label("conversation_id")}, '') = '' THEN chr(1) || msg_id ELSE {label("conversation_id")} END AS cid,
         coalesce(CASE WHEN regexp_full_match({_number}, '[+-]?[0-9]+') THEN try_cast({_number} AS bigint)::varchar END, {_number}, '') AS number,
         lower({label("coalesce(role, '')")}) AS role, {strip("coalesce(content, '')")} AS content, source_name, {_code} AS language
  FROM messages),
each AS (
  SELECT cid, content, arg_min({{'s': source_name, 'l': language}}, (source_name IS NOT NULL, coalesce(source_name, ''), language IS NOT NULL, coalesce(language, ''))) AS m
  FROM rows GROUP BY cid, number, role, content),
dom AS (SELECT {label("conversation_id")} AS cid, min(domain_code) AS domain_code FROM threads GROUP BY 1),
slices AS (SELECT content, m.s AS source_name, m.l AS language, domain_code, count(*) AS times FROM each LEFT JOIN dom USING (cid) GROUP BY ALL)
SELECT source_name, language, domain_code, sum(times)::bigint AS messages, count(*) AS texts FROM slices GROUP BY ALL""",
    "p4_found": f"WITH {_LENGTHS} SELECT profile_name, cid AS conversation_id FROM long JOIN pack_profiles ON n > max_chars",
    "p4_totals": f"""WITH {_LENGTHS}
SELECT profile_name, count(*) AS conversations, sum(greatest(1, ceil(n / max_chars)))::bigint AS fragments, sum(n)::bigint AS chars, 0::bigint AS overfull
FROM long, pack_profiles WHERE max_chars > 0 GROUP BY profile_name""",
    "p6_found": f"""WITH RECURSIVE {_GROUPS},
placed AS (SELECT s.id, s.split, coalesce(root, s.id) AS root FROM splits s LEFT JOIN member ON node = s.id)
SELECT DISTINCT id AS conversation_id FROM placed WHERE root IN (SELECT root FROM placed GROUP BY root HAVING count(DISTINCT split) > 1)""",
    "p6_isolation": f"""WITH RECURSIVE {_GROUPS},
placed AS (SELECT ids.id, coalesce(root, ids.id) AS root FROM ids LEFT JOIN member ON node = ids.id WHERE ids.id <> '')
SELECT count(*) AS conversations, count(DISTINCT root) AS groups, 0::bigint AS divided, true AS shares_met FROM placed""",
    "p5_found": f"WITH {LOG} SELECT cid AS conversation_id FROM judged WHERE dropped",
    "p5_conversations": f"""WITH {LOG}
SELECT cid AS conversation_id, count(*) AS n_messages, sha256(string_agg(role || ':' || content, chr(10) ORDER BY turn)) AS digest
FROM ordered JOIN judged USING (cid) WHERE NOT dropped GROUP BY cid""",
}

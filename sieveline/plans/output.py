"""Queries of model calls, model output, text heuristics, rule tables with options, promotion, loops and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flags as fl
from ..functions import text as tx
from ..operators import balance, merge, parse, rules, state, vote
from ..sources import providers
from ..sources import tables as io
from ._base import Registry, posts, sql_norm, table, verdicts
from .analysis import _VOTE, PROFILE

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _connect():
    """A stand-in for a service: prompts that end in 3 fail once, those that end in 7 always."""
    calls: dict[str, int] = {}

    def call(prompt: str) -> str:
        calls[prompt] = calls.get(prompt, 0) + 1
        if prompt.endswith("7") or prompt.endswith("3") and calls[prompt] == 1:
            raise OSError("no answer")
        return prompt.upper()

    return call


@query("""
SELECT event_id, CASE WHEN event_id % 10 <> 7 THEN 'P' || CAST(event_id AS VARCHAR) END AS raw, CASE WHEN event_id % 10 = 7 THEN 'OSError: no answer' END AS error,
       CASE event_id % 10 WHEN 7 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS attempts FROM events
""")
def a13_model_calls(spark: SparkSession, d: str) -> DataFrame:
    """A13 and N3: calls through a caller's function, again until they succeed or the retries are over."""
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("prompt"))
    return providers.call_model(e, _connect, "event_id", "prompt", 2, 0.0).select("event_id", "raw", "error", "attempts")


@query("SELECT _ord, upper('classify ' || label || ' of ' || source) AS raw, CAST(NULL AS VARCHAR) AS error FROM posts")
def a13_call_log(spark: SparkSession, d: str) -> DataFrame:
    """A13 with a durable log: a prompt is paid for once, here in two runs of which the second finds the first one's answers."""
    root = io.work_path(spark, "calls")
    p = posts(spark, d).select("_ord", F.concat(F.lit("classify "), "label", F.lit(" of "), "source").alias("prompt"))
    connect = lambda: str.upper
    providers.logged_calls(p.where("_ord % 2 = 0"), connect, "_ord", "prompt", root, 2, 0.0)
    return providers.logged_calls(p, connect, "_ord", "prompt", root, 2, 0.0).select("_ord", "raw", "error")


@query("""
WITH s AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY _ord) <= CASE label WHEN 'L1' THEN 20 ELSE 35 END AS main
           FROM (SELECT label, min(_ord) AS _ord FROM posts WHERE label IN ('L1', 'L2') GROUP BY label, key))
SELECT label, count(*) FILTER (WHERE main) AS main, count(*) FILTER (WHERE NOT main) AS overflow, greatest(40 - count(*) FILTER (WHERE main), 0) AS still_needed FROM s GROUP BY label
""")
def b8_main_overflow_report(spark: SparkSession, d: str) -> DataFrame:
    """The three outputs of a generation run, written and read back."""
    root = io.work_path(spark, "triple")
    p = posts(spark, d).where(F.col("label").isin("L1", "L2")).withColumn("key", tx.lower_key("clean_text"))
    io.write_triple(balance.split_main_overflow(p, {"L1": 20, "L2": 35}, "label", "key"), "label", 40, root)
    main, overflow, report = (spark.read.parquet(f"{root}/{x}") for x in ("main", "overflow", "report"))
    n = main.groupBy("label").agg(F.count("*").alias("main")).join(overflow.groupBy("label").agg(F.count("*").alias("overflow")), "label", "left").fillna(0)
    return n.join(report.select("label", "still_needed"), "label").select("label", "main", "overflow", "still_needed")


@query(_VOTE + """,
w AS (SELECT content_id, max(CASE WHEN juror = 'A' THEN violation END) AS a, max(CASE WHEN juror = 'B' THEN violation END) AS b, max(CASE WHEN juror = 'C' THEN violation END) AS c, sum(latency_ms) AS ms FROM verdicts GROUP BY content_id),
j AS (SELECT *, a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AS whole FROM voted JOIN w USING (content_id)), n AS (SELECT count(*) AS n FROM j),
long AS (SELECT 'category' AS section, final_category AS item FROM j UNION ALL SELECT 'violation', coalesce(CAST(final_violation AS VARCHAR), 'null') FROM j
         UNION ALL SELECT 'vote_method', vote_method FROM j UNION ALL SELECT 'rows', 'all' FROM j)
SELECT section, item, CAST(count(*) AS DOUBLE) AS n, round(count(*) / (SELECT n FROM n) * 100, 1) AS pct FROM long GROUP BY ALL
UNION ALL SELECT 'latency', 'mean_total_ms', round(avg(ms), 4), NULL FROM j
UNION ALL SELECT 'agreement', 'unanimous', CAST(count(*) FILTER (WHERE whole AND a = b AND b = c) AS DOUBLE), round(count(*) FILTER (WHERE whole AND a = b AND b = c) / count(*) FILTER (WHERE whole) * 100, 1) FROM j
""")
def b9_annotation_report(spark: SparkSession, d: str) -> DataFrame:
    v = verdicts(spark, d)
    results = vote.majority_vote(v, PROFILE).join(vote.wide(v, ["violation"]), "content_id").join(vote.latency(v), "content_id")
    return vote.annotation_report(results)


def _by_turn(*texts: str | None) -> Column:
    """The text by _ord in turn, {} standing for the post's own."""
    n = len(texts)
    out = None
    for i, t in enumerate(texts):
        parts = [] if t is None else t.split("{}")
        text = F.lit(None).cast("string") if t is None else F.concat(*[x for k, p in enumerate(parts) for x in ([F.col("clean_text")] if k else []) + [F.lit(p)]])
        out = F.when(F.col("_ord") % n == i, text) if out is None else out.when(F.col("_ord") % n == i, text)
    return out


def _sql_turn(*texts: str | None) -> str:
    quote = lambda t: "NULL" if t is None else " || clean_text || ".join("'" + p.replace("'", "''") + "'" for p in t.split("{}"))
    return f"CASE _ord % {len(texts)} " + " ".join(f"WHEN {i} THEN {quote(t)}" for i, t in enumerate(texts)) + " END"


_META = ("{}", "Etiqueta", "x etiqueta y {}", "{} Training Sample of", None, "", "a\ta continuación {}")


@query(f"SELECT _ord, {' OR '.join(f'contains(t, {chr(39)}{p}{chr(39)})' for p in tx.META_TALK)} AS meta FROM (SELECT _ord, ' ' || lower(coalesce({_sql_turn(*_META)}, '')) || ' ' AS t FROM posts)")
def j9_meta_talk(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", tx.meta_talk(_by_turn(*_META)).alias("meta"))


_ONLY = ("{}", "http://a.example/{}", " WWW.x.org/y ", "[link]", "#a  #b", "# {}", "!! ?", "", None, "1", "#x\n#y", "link {}")


@query(f"""
SELECT _ord, regexp_full_match(t, '(?i)https?://\\S+|www\\.\\S+|\\[?link\\]?') AS url_only,
       t <> '' AND len(list_filter(string_split({sql_norm('t')}, ' '), lambda w: NOT starts_with(w, '#'))) = 0 AS hashtag_only, NOT regexp_matches(t, '{tx.LETTER_OR_DIGIT}') AS symbol_only
FROM (SELECT _ord, trim(coalesce({_sql_turn(*_ONLY)}, '')) AS t FROM posts)
""")
def j10_only_one_kind(spark: SparkSession, d: str) -> DataFrame:
    t = _by_turn(*_ONLY)
    return posts(spark, d).select("_ord", tx.url_only(t).alias("url_only"), tx.hashtag_only(t).alias("hashtag_only"), tx.symbol_only(t).alias("symbol_only"))


_ARTIFACTS = ("{}", "at https://x.example/{}", "on www.x.org", "{} 10.0.0.1", "A.B@c.example {}", "key SK-abcdefghijkl {}", "{} 12345678901", "12345", "curl -s x", "a <SCRIPT>", "{} select a from b", "Union  Select", "DROP TABLE t", None, "select nothing", "python")


def _sql_any(patterns: tuple[str, ...]) -> str:
    return " OR ".join(f"regexp_matches(t, '(?i){p}')" for p in patterns)


@query(f"SELECT _ord, {_sql_any(tx.REAL_ARTIFACTS)} AS real_artifact, {_sql_any(tx.OPERATIONAL_ARTIFACTS)} AS operational FROM (SELECT _ord, coalesce({_sql_turn(*_ARTIFACTS)}, '') AS t FROM posts)")
def j11_artifacts(spark: SparkSession, d: str) -> DataFrame:
    t = _by_turn(*_ARTIFACTS)
    return posts(spark, d).select("_ord", tx.has_artifact(t, tx.REAL_ARTIFACTS).alias("real_artifact"), tx.has_artifact(t, tx.OPERATIONAL_ARTIFACTS).alias("operational"))


@query("SELECT _ord, TRUE AS iso, TRUE AS now FROM posts")
def j17_annotated_at(spark: SparkSession, d: str) -> DataFrame:
    """The clock itself can't be in a checked result; its form and closeness can."""
    at = fl.now_utc()
    return posts(spark, d).select("_ord", at.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$").alias("iso"), (F.abs(F.unix_micros(F.to_timestamp(at)) - F.unix_micros(F.current_timestamp())) < 1000).alias("now"))


_FENCED = (" ```JSON\n[{\"a\": 1}, {\"b\": [2, 3]}]\n```\n", "[1, [2], {}]", "Here: [7, 8] done", "```\n{\"k\": 1}\n```", "[1, 2", None, "{\"a\": [1, 2, 3]}", "[]")
_SQL_FENCE = f"trim(regexp_replace(regexp_replace(trim(coalesce({_sql_turn(*[t and t.replace('{}', '9') for t in _FENCED])}, ''), chr(32) || chr(10)), '^```(json)?[ \\n]*', '', 'i'), '[ \\n]*```$', ''), chr(32) || chr(10))"


@query(f"SELECT _ord, {_SQL_FENCE} AS body FROM posts")
def k1_strip_fence(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", parse.strip_fence(_by_turn(*[t and t.replace("{}", "9") for t in _FENCED])).alias("body"))


@query(f"""
WITH b AS (SELECT _ord, {_SQL_FENCE} AS t FROM posts), c AS (SELECT _ord, t, regexp_extract(t, '(?s)(\\[.*\\])', 1) AS u FROM b)
SELECT _ord, CAST(CASE WHEN json_valid(t) AND json_type(t) = 'ARRAY' THEN json_array_length(t) WHEN u <> '' AND json_valid(u) AND json_type(u) = 'ARRAY' THEN json_array_length(u) END AS INT) AS n_items FROM c
""")
def k2_json_array(spark: SparkSession, d: str) -> DataFrame:
    arr = F.try_variant_get(parse.json_array(_by_turn(*[t and t.replace("{}", "9") for t in _FENCED])), "$", "array<variant>")
    return posts(spark, d).select("_ord", F.when(arr.isNotNull(), F.size(arr)).alias("n_items"))


_LINES = ('{"a": 1},\n{"a": 2}\n', '[{"a": 1}, {"a": 2}, 3]', '{"a": 1}\n{"a": ', "7\n8\n\n9", "```jsonl\n1,\n2\n```", "", None, "x [1, 2] y")


@query(f"""
WITH b AS (SELECT _ord, trim(regexp_replace(regexp_replace(trim(coalesce({_sql_turn(*_LINES)}, ''), chr(32) || chr(10)), '^```(jsonl?)?[ \\n]*', '', 'i'), '[ \\n]*```$', ''), chr(32) || chr(10)) AS t FROM posts),
c AS (SELECT _ord, t, regexp_extract(t, '(?s)(\\[.*\\])', 1) AS u, list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(trim(x), ',+$', '')), lambda x: x <> '') AS l FROM b)
SELECT _ord, CAST(CASE WHEN json_valid(t) AND json_type(t) = 'ARRAY' THEN json_array_length(t) WHEN u <> '' AND json_valid(u) THEN json_array_length(u)
       WHEN len(l) > 0 AND len(list_filter(l, lambda x: NOT json_valid(x))) = 0 THEN len(l) END AS INT) AS n FROM c
""")
def k3_json_lines(spark: SparkSession, d: str) -> DataFrame:
    got = parse.records(_by_turn(*_LINES))
    return posts(spark, d).select("_ord", F.when(got.isNotNull(), F.size(got)).alias("n"))


_SAID = '{"violation": true, "confidence": "0.5", "category": "L1", "reason_code": "r1"'
_VERDICTS = (
    "```json\n" + _SAID + "}\n```", "so " + _SAID + "} there", _SAID, _SAID + ",}", '{"violation": false, "category": "L2", "confidence": 0.25, "usable": true, "risk_level": "low"}',
    '{"violation": true, "category": "none", "label_match": "no"}', '{"violation": true, "category": "L77"}', '{"category": "L2", "audit_action": "review", "confirmed_label": "L3"}', "no verdict", '{"violation": "true", "category": "L1"}', None,
)


@query(f"""
WITH r AS (SELECT _ord, {_sql_turn(*_VERDICTS)} AS raw FROM posts),
a AS (SELECT _ord, raw, trim(regexp_replace(coalesce(raw, ''), '^```json|```$', '', 'g'), chr(32) || chr(10)) AS t FROM r),
b AS (SELECT *, CASE WHEN NOT json_valid(t) AND NOT starts_with(t, '{{') AND regexp_matches(t, '\\{{[^{{}}]*\\}}') THEN regexp_extract(t, '\\{{[^{{}}]*\\}}') ELSE t END AS u FROM a),
c AS (SELECT *, CASE WHEN json_valid(u) THEN u WHEN json_valid(u || '}}') THEN u || '}}' ELSE regexp_replace(u, ',\\s*\\}}', '}}') END AS w FROM b),
j AS (SELECT _ord, raw, CASE WHEN json_valid(w) AND json_type(w) = 'OBJECT' THEN w END AS j FROM c),
f AS (SELECT *, json_extract_string(j, '$.category') AS said, CASE WHEN json_type(j, '$.violation') = 'BOOLEAN' THEN CAST(json_extract_string(j, '$.violation') AS BOOLEAN) END AS v FROM j),
g AS (SELECT *, CASE WHEN said IN ('L1', 'L2', 'L3', 'L4', 'L5') THEN said WHEN said IN ('none', 'safe') THEN 'L5' END AS c FROM f)
SELECT _ord, CASE WHEN c IS NULL THEN NULL WHEN c = 'L5' THEN FALSE ELSE v END AS violation, CASE WHEN c IS NULL OR v = FALSE THEN 'L5' ELSE c END AS category,
       coalesce(json_extract_string(j, '$.confirmed_label'), CASE WHEN c IS NULL OR v = FALSE THEN 'L5' ELSE c END) AS confirmed_label, coalesce(TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE), 0) AS confidence,
       CASE WHEN j IS NULL THEN 'Failed to parse JSON response after 3 attempts. Raw: ' || left(coalesce(raw, ''), 500) ELSE '' END AS reasoning,
       json_extract_string(j, '$.usable') AS usable, json_extract_string(j, '$.label_match') AS label_match, coalesce(json_extract_string(j, '$.risk_level'), '') AS risk_level,
       coalesce(json_extract_string(j, '$.audit_action'), '') AS audit_action, coalesce(json_extract_string(j, '$.reason_code'), '') AS reason_code,
       CASE WHEN j IS NULL THEN 'JSON parse error: could not extract valid JSON from response' WHEN c IS NULL THEN 'Invalid category from model: ' || said
            WHEN c <> 'L5' AND v IS NULL THEN 'Missing or invalid violation field from model' END AS error FROM g
""")
def k5_tolerant_verdict(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).select("_ord", _by_turn(*_VERDICTS).alias("raw"))
    return parse.verdicts(p, profile=PROFILE).drop("raw")


_BATCHES = ('```json\n[{"clean_text": "  one   x ", "final_category": " L1 "}, 7, {"clean_text": "two"}]\n```', 'Here: [{"final_category": "L2", "other": [1]}] done', "[]", '[{"clean_text": "broken"', None)


@query(f"""
WITH r AS (SELECT _ord, {_sql_turn(*_BATCHES)} AS raw FROM posts), t AS (SELECT _ord, regexp_extract(coalesce(raw, ''), '(?s)(\\[.*\\])', 1) AS u FROM r),
i AS (SELECT _ord, unnest(range(CAST(json_array_length(u) AS BIGINT))) AS k, u FROM t WHERE u <> '' AND json_valid(u)), o AS (SELECT _ord, k, json_extract(u, '$[' || k || ']') AS x FROM i)
SELECT {sql_norm("json_extract_string(x, '$.clean_text')")} AS clean_text, trim(coalesce(json_extract_string(x, '$.final_category'), '')) AS final_category,
       'b' || lpad(CAST(_ord AS VARCHAR), 6, '0') AS batch_id, 'b' || lpad(CAST(_ord AS VARCHAR), 6, '0') || '__item_' || lpad(CAST(k AS VARCHAR), 2, '0') AS item_id FROM o WHERE json_type(x) = 'OBJECT'
""")
def k6_batch_rows(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).select(F.format_string("b%06d", "_ord").alias("batch_id"), _by_turn(*_BATCHES).alias("raw_output"))
    return parse.raw_rows(p, "m").select("clean_text", "final_category", "batch_id", "item_id")


_GENERATED = ("{}", "", "{} 漢字", "{} foreign thing", "{} as a language model", "{} mail a@b.example", "short", None)


@query(f"""
SELECT _ord, CASE WHEN t = '' THEN 'empty_clean_text' WHEN label = 'L3' THEN 'wrong_final_category' WHEN length(t) NOT BETWEEN 8 AND 4000 THEN 'bad_length_' || CAST(length(t) AS VARCHAR)
  WHEN len(regexp_extract_all(t, '[\\x{{4e00}}-\\x{{9fff}}]')) >= 2 THEN 'chinese_detected' WHEN contains(' ' || lower(t) || ' ', ' foreign thing ') THEN 'obviously_foreign_response'
  WHEN contains(' ' || lower(t) || ' ', ' as a language model ') THEN 'refusal_text' WHEN {_sql_any(tx.REAL_ARTIFACTS + tx.OPERATIONAL_ARTIFACTS)} THEN 'operational_artifact' END AS reason
FROM (SELECT _ord, label, {sql_norm(_sql_turn(*_GENERATED))} AS t FROM posts)
""")
def l1_all_reasons(spark: SparkSession, d: str) -> DataFrame:
    """L1 with every reason there is, in order."""
    p = posts(spark, d).withColumn("t", _by_turn(*_GENERATED))
    wanted = F.when(F.col("label") == "L3", "L4").otherwise(F.col("label"))
    reason = rules.rejection(F.col("t"), F.col("label"), wanted, 8, 4000, [" as a language model "], tx.contains_any("t", [" foreign thing "]), artifacts=True)
    return p.select("_ord", reason.alias("reason"))


@query(f"""
SELECT _ord, CASE WHEN n = '' THEN 'empty' WHEN length(n) NOT BETWEEN 8 AND 800 OR regexp_full_match(n, '(?i)https?://\\S+|www\\.\\S+|\\[?link\\]?')
  OR len(list_filter(string_split(n, ' '), lambda w: NOT starts_with(w, '#'))) = 0 OR NOT regexp_matches(n, '{tx.LETTER_OR_DIGIT}') OR contains(' ' || lower(n) || ' ', ' training sample ') THEN 'invalid' END AS reason
FROM (SELECT _ord, {sql_norm(_sql_turn("{}", "http://a.example/long", "#one #two #three", "!!!!! ?????", "a Training Sample here", "#one two three", None, "plain words here"))} AS n FROM posts)
""")
def l2_all_reasons(spark: SparkSession, d: str) -> DataFrame:
    t = _by_turn("{}", "http://a.example/long", "#one #two #three", "!!!!! ?????", "a Training Sample here", "#one two three", None, "plain words here")
    return posts(spark, d).select("_ord", rules.invalid_text(t, [" training sample "]).alias("reason"))


#: A table of the second kind: each label has its own rules and its own keep, and two of them an optional drop.
_BASE = (
    rules.Rule("L1", "drop", "l1_both_drop", all_of=("thing", "tion")), rules.Rule("L1", "keep", "l1_keep"),
    rules.Rule("L2", "relabel", "l2_to_l7", "L7", all_of=("eaux",)), rules.Rule("L2", "keep", "l2_keep"),
    rules.Rule("L4", "relabel", "l4_to_l7", "L7", all_of=("hing",), exempt="thing"), rules.Rule("L4", "keep", "l4_keep"),
)
_IF_ABSENT = (rules.Rule("L2", "drop", "l2_no_clear_sign_drop", none_of=("mente",)),)
_IF_PRESENT = (rules.Rule("L4", "drop", "l4_neutral_drop", all_of=("ever",)),)


def _l4_sql(on: bool) -> str:
    absent, present = (" WHEN label = 'L2' AND NOT contains(t, 'mente') THEN 'l2_no_clear_sign_drop'", " WHEN label = 'L4' AND contains(t, 'ever') THEN 'l4_neutral_drop'") if on else ("", "")
    return f"""
SELECT _ord, CASE WHEN ends_with(reason, '_drop') THEN 'drop' WHEN contains(reason, '_to_') THEN 'relabel' ELSE 'keep' END AS action, reason, CASE WHEN contains(reason, '_to_') THEN 'L7' END AS new_label
FROM (SELECT _ord, CASE WHEN label = 'L1' AND contains(t, 'thing') AND contains(t, 'tion') THEN 'l1_both_drop' WHEN label = 'L1' THEN 'l1_keep' WHEN label = 'L2' AND contains(t, 'eaux') THEN 'l2_to_l7'{absent}
        WHEN label = 'L2' THEN 'l2_keep' WHEN label = 'L4' AND contains(replace(t, 'thing', ' '), 'hing') THEN 'l4_to_l7'{present} WHEN label = 'L4' THEN 'l4_keep' ELSE 'label_not_target_keep' END AS reason
      FROM (SELECT _ord, label, lower(clean_text) AS t FROM posts))
"""


@query(_l4_sql(False))
def l4_boundary_rules(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", rules.decide(F.col("label"), F.col("clean_text"), rules.boundary_rules(base=_BASE), otherwise="label_not_target_keep").alias("x")).select("_ord", "x.*")


@query(_l4_sql(True))
def l4_boundary_rules_with_drops(spark: SparkSession, d: str) -> DataFrame:
    table_ = rules.boundary_rules(_IF_ABSENT, _IF_PRESENT, _BASE)
    return posts(spark, d).select("_ord", rules.decide(F.col("label"), F.col("clean_text"), table_, otherwise="label_not_target_keep").alias("x")).select("_ord", "x.*")


@query("""
WITH o AS (SELECT * FROM posts WHERE _ord % 2 = 1), once AS (SELECT trim(clean_text) AS k, min(_ord) AS _ord, arg_min(label, _ord) AS label FROM o GROUP BY 1),
moved AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY _ord) AS rn FROM once WHERE label IN ('L2', 'L4')) WHERE rn <= CASE label WHEN 'L2' THEN 5 ELSE 30 END)
SELECT _ord, 'main' AS part FROM posts WHERE _ord % 2 = 0 UNION ALL SELECT _ord, 'main' FROM moved
UNION ALL SELECT _ord, 'overflow' FROM o WHERE trim(clean_text) NOT IN (SELECT k FROM moved)
""")
def n6_promote_overflow(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d)
    main, rest = balance.promote(p.where("_ord % 2 = 0"), p.where("_ord % 2 = 1"), {"L2": 5, "L4": 30}, "label", "clean_text")
    return main.select("_ord", F.lit("main").alias("part")).unionByName(rest.select("_ord", F.lit("overflow").alias("part")))


@query("SELECT l.label, greatest(140, count(p._ord)) AS n FROM (VALUES ('L1'), ('L2'), ('L99')) AS l(label) LEFT JOIN posts p ON p.label = l.label GROUP BY l.label")
def n8_fill_to_target(spark: SparkSession, d: str) -> DataFrame:
    """The bounded loop over a stand-in that gives every text twice."""
    p = posts(spark, d).select("_ord", "clean_text", "label")

    def ask(label: str, n: int, k: int) -> DataFrame:
        return spark.range(n).select(F.col("id").alias("_ord"), F.format_string(f"{label} {k} %d", F.floor(F.col("id") / 2)).alias("clean_text"))

    now, _ = state.fill_to_target(p, ask, ["L1", "L2", "L99"], 140, 60, 60, label="label")
    return merge.distribution(now, "label", ["L1", "L2", "L99"], 140).select("label", F.col("count").alias("n"))

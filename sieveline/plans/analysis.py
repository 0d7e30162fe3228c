"""Queries of merging, aggregation, voting, parsing, rules, balance, metrics and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flags as fl
from ..functions import text as tx
from ..functions.keys import halves
from ..operators import balance, dedup, keywords, merge, metrics, rules, state, vote
from ..sources import tables as io
from ..streaming import jobs
from ._base import FLAGS, LABELS, Registry, flagged, fresh, posts, seen, sql_key, sql_norm, table, verdicts

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
F3 = FLAGS[:3]

_MERGE = f"""
WITH t AS (SELECT language, {sql_norm('clean_text')} AS k, arg_max({sql_norm('clean_text')}, _ord) AS text, arg_max(label, _ord) AS label_name, arg_max(source, _ord) AS train_source
           FROM flagged WHERE _ord % 3 = 0 GROUP BY ALL),
n AS (SELECT language, {sql_norm('clean_text')} AS k, count(*) AS n, max(f1) AS f1, max(f2) AS f2, max(f3) AS f3 FROM flagged WHERE _ord % 3 <> 0 GROUP BY ALL),
merged AS (SELECT coalesce(t.language, n.language) AS language, md5(coalesce(t.k, n.k)) AS key, coalesce(t.k, n.k) AS text, coalesce(label_name, '') AS label_name,
       coalesce(f1, 0) AS f1, coalesce(f2, 0) AS f2, coalesce(f3, 0) AS f3, coalesce(train_source, '') AS train_source,
       CASE WHEN t.k IS NOT NULL AND n.k IS NULL THEN 'train_only' WHEN t.k IS NOT NULL OR n.n >= 2 THEN 'both' ELSE 'new_only' END AS origin
  FROM t FULL JOIN n ON t.k = n.k AND t.language = n.language)
"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    p = flagged(spark, d).withColumnsRenamed({"clean_text": "text", "label": "label_name"})
    return merge.merge_schemas(p.where("_ord % 3 = 0"), p.where("_ord % 3 <> 0"), F3, ["language"])


@query(_MERGE + "SELECT * FROM merged")
def e3_merge_schemas(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d)


@query(_MERGE + "SELECT * FROM merged")
def e3_merge_batches(spark: SparkSession, d: str) -> DataFrame:
    """E3 as an upsert: a corpus bucketed by key takes in both schemas in three batches and is not shuffled by any."""
    p = flagged(spark, d).withColumnsRenamed({"clean_text": "text", "label": "label_name"})
    corpus = merge.KeyedCorpus(spark, io.work_path(spark, "corpus"), F3, ["language"], buckets=max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    train, new = p.where("_ord % 3 = 0"), p.where("_ord % 3 <> 0")
    corpus.absorb(1, train.where("_ord % 2 = 0"), new.where("_ord % 5 = 1"))
    corpus.absorb(2, None, new.where("_ord % 5 > 1"))
    corpus.absorb(3, train.where("_ord % 2 = 1"), new.where("_ord % 5 = 0"))
    return corpus.view()


@query("SELECT source, count(*) AS n, min(_ord) AS first_seen FROM posts GROUP BY source")
def f1_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return merge.value_counts(posts(spark, d), "source")


_DIST = "SELECT l.label, count(p._ord) AS count, greatest(200 - count(p._ord), 0) AS gap FROM (VALUES ('L1'), ('L2'), ('L99')) AS l(label) LEFT JOIN posts p ON p.label = l.label GROUP BY l.label"


@query(_DIST)
def f2_distribution(spark: SparkSession, d: str) -> DataFrame:
    """zero-filled counts and gaps."""
    return merge.distribution(posts(spark, d), "label", ["L1", "L2", "L99"], 200)


@query("SELECT label, count(*) AS n, greatest(0, 150 - count(*)) AS gap, round(count(*) / 5000 * 100, 1) AS pct FROM posts GROUP BY label")
def f4_percent_of_target(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return posts(spark, d).groupBy("label").agg(n.alias("n"), F.greatest(F.lit(150) - n, F.lit(0)).alias("gap"), F.round(n / 5000 * 100, 1).alias("pct"))


@query("SELECT label, CASE WHEN label <> 'L1' THEN round_even(count(*) / 160, 3) END AS ratio FROM posts GROUP BY label")
def f5_ratio_to_need(spark: SparkSession, d: str) -> DataFrame:
    n = posts(spark, d).groupBy("label").agg(F.count("*").alias("n"))
    return n.select("label", merge.ratio_to_need(F.col("n"), F.when(F.col("label") == "L1", 0).otherwise(160)).alias("ratio"))


@query("SELECT count(*) FILTER (WHERE f1 = 1) AS a, count(*) FILTER (WHERE f2 = 1 AND f3 = 1) AS b, count(*) FILTER (WHERE language = 'de') AS c FROM flagged")
def f6_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).agg(F.count_if(F.col("f1") == 1).alias("a"), F.count_if((F.col("f2") == 1) & (F.col("f3") == 1)).alias("b"), F.count_if(F.col("language") == "de").alias("c"))


@query("""
SELECT count(*) AS total, count(*) FILTER (WHERE f1 + f2 + f3 > 0) AS positive, count(*) FILTER (WHERE f1 + f2 + f3 = 0) AS all_zero,
       count(*) FILTER (WHERE key IN (SELECT key FROM seen WHERE key <> '')) AS already_seen FROM flagged
""")
def f7_funnel(spark: SparkSession, d: str) -> DataFrame:
    key = tx.lower_key("clean_text")
    keys = dedup.key_hashes(seen(spark, d), key).withColumn("hit", F.lit(True))
    h1, h2 = halves(key)
    f = flagged(spark, d).select(*F3, h1.alias("h1"), h2.alias("h2")).join(keys, ["h1", "h2"], "left")
    return f.agg(F.count("*").alias("total"), F.count_if(fl.any_flag(F3)).alias("positive"), F.count_if(~fl.any_flag(F3)).alias("all_zero"), F.count_if("hit").alias("already_seen"))


@query(_MERGE + """,
long AS (SELECT language, 'label_name' AS label_type, label_name AS label, 1 AS v FROM merged WHERE label_name <> ''
  UNION ALL SELECT language, 'raw_label', 'f1', f1 FROM merged UNION ALL SELECT language, 'raw_label', 'f2', f2 FROM merged UNION ALL SELECT language, 'raw_label', 'f3', f3 FROM merged),
c AS (SELECT CASE WHEN grouping(language) = 1 THEN 'ALL' ELSE language END AS language, label_type, label, CAST(sum(v) AS BIGINT) AS current_count
      FROM long GROUP BY GROUPING SETS ((language, label_type, label), (label_type, label)))
SELECT language, label_type, label, current_count, greatest(5000 - current_count, 0) AS need, round(current_count / 5000 * 100, 1) AS pct_of_target FROM c
UNION ALL SELECT language, 'meta', 'total_rows=' || CAST(count(*) AS VARCHAR), count(*), NULL, NULL FROM merged GROUP BY language
UNION ALL SELECT language, 'meta', 'origin_' || origin, count(*), NULL, NULL FROM merged GROUP BY language, origin
""")
def f8_corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    return merge.corpus_summary(_merged(spark, d), F3, 5000)


@query("""
WITH n AS (SELECT label, source, count(*) AS n FROM posts GROUP BY ALL),
cells AS (FROM n UNION ALL SELECT l.label, s.source, 0 FROM (SELECT DISTINCT label FROM posts) l, (SELECT DISTINCT source FROM posts) s)
SELECT CASE WHEN grouping(label) = 1 THEN 'All' ELSE label END AS label, CASE WHEN grouping(source) = 1 THEN 'All' ELSE source END AS source, CAST(sum(n) AS BIGINT) AS n
FROM cells GROUP BY CUBE (label, source)
""")
def f9_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return merge.crosstab_long(posts(spark, d), "label", "source")


@query("SELECT label, count(DISTINCT key) AS unique_texts FROM posts WHERE key <> '' GROUP BY label")
def f10_distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    return metrics.distinct_keys(posts(spark, d), "label", "clean_text")


@query("SELECT content_id, sum(latency_ms) AS total_latency_ms, max(latency_ms) AS max_latency_ms, avg(latency_ms) AS mean_latency_ms FROM verdicts GROUP BY content_id")
def f11_latency(spark: SparkSession, d: str) -> DataFrame:
    return vote.latency(verdicts(spark, d))


PROFILE = vote.Profile({"L1": 5, "L2": 3, "L3": 4, "L4": 3}, neutral="L5")

#: Verdicts put in order (L5 is the neutral label), then the decision table.
_VOTE = """
WITH v AS (
  SELECT content_id, juror, CASE WHEN category = 'L5' THEN FALSE ELSE violation END AS violation,
         CASE WHEN category = 'L5' OR violation = FALSE THEN 'L5' ELSE category END AS category FROM verdicts),
g AS (
  SELECT content_id, count(*) FILTER (WHERE violation) AS y, count(*) FILTER (WHERE NOT violation) AS n, count(*) FILTER (WHERE violation IS NULL) AS u,
         arg_max(category, CASE category WHEN 'L1' THEN 5 WHEN 'L2' THEN 3 WHEN 'L3' THEN 4 WHEN 'L4' THEN 3 ELSE 0 END * 10 - CASE juror WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END) FILTER (WHERE violation) AS top,
         string_agg('Juror_' || juror || ':' || CASE WHEN violation THEN 'violation' WHEN NOT violation THEN 'clean' ELSE 'null' END, ' / ' ORDER BY juror) AS vote_agreement
  FROM v GROUP BY content_id),
voted AS (
  SELECT content_id, CASE WHEN u < 2 AND y >= 2 THEN TRUE WHEN u < 2 AND n >= 2 THEN FALSE END AS final_violation,
         CASE WHEN u < 2 AND y >= 2 THEN top ELSE 'L5' END AS final_category,
         CASE WHEN u >= 2 THEN 'all_null' WHEN y = 3 OR n = 3 THEN 'unanimous' WHEN y = 2 OR n = 2 THEN 'majority' ELSE 'split' END AS vote_method, vote_agreement,
         NOT (u < 2 AND (y >= 2 OR n >= 2)) AS requires_review,
         CASE WHEN u >= 2 THEN 'safe' WHEN y = 3 OR n = 3 THEN 'consensus' WHEN y = 2 OR n = 2 THEN 'majority' ELSE 'safe' END AS adopted_juror,
         CASE WHEN u < 2 AND y = 2 THEN 2 WHEN u < 2 AND n = 2 THEN 1 ELSE y END AS violation_count,
         CASE WHEN u < 2 AND y = 2 THEN 1 WHEN u < 2 AND n = 2 THEN 2 ELSE n END AS clean_count,
         y AS true_violation_count, n AS true_clean_count, u AS true_null_count FROM g)
"""


@query(_VOTE + "SELECT * FROM voted")
def f12_majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return vote.majority_vote(verdicts(spark, d), PROFILE)


@query(_VOTE + "SELECT content_id, top AS category FROM g WHERE y > 0")
def f13_category_by_priority(spark: SparkSession, d: str) -> DataFrame:
    v = vote.validated(verdicts(spark, d), PROFILE).where("violation")
    order = F.struct(vote._priority(F.col("category"), PROFILE), -F.array_position(F.array(*[F.lit(j) for j in "ABC"]), F.col("juror")))
    return v.groupBy("content_id").agg(F.max_by("category", order).alias("category"))


@query("""
WITH c AS (SELECT content_id, category, count(*) AS n FROM verdicts WHERE category <> 'L5' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY n DESC, category) AS rn FROM c)
SELECT p._ord AS content_id, coalesce(r.category, '') AS category FROM posts p LEFT JOIN r ON r.content_id = p._ord AND rn = 1
""")
def f14_majority_item(spark: SparkSession, d: str) -> DataFrame:
    v = verdicts(spark, d).withColumn("category", F.when(F.col("category") != "L5", F.col("category")).otherwise(" "))
    return vote.majority_item(v, "category")


@query("""
SELECT content_id, CASE WHEN count(*) FILTER (WHERE violation) > count(*) FILTER (WHERE NOT violation) THEN TRUE
       WHEN count(*) FILTER (WHERE violation) < count(*) FILTER (WHERE NOT violation) THEN FALSE END AS usable FROM verdicts GROUP BY content_id
""")
def f15_majority_bool(spark: SparkSession, d: str) -> DataFrame:
    v = verdicts(spark, d).withColumn("usable", F.when(F.col("juror") == "A", F.col("violation").cast("string")).otherwise(F.initcap(F.col("violation").cast("string"))))
    return vote.majority_bool(v, "usable")


_WIDE = "WITH w AS (SELECT content_id, " + ", ".join(f"max(CASE WHEN juror = '{j}' THEN {c} END) AS juror_{j.lower()}_{c}" for j in "ABC" for c in ("violation", "category", "latency_ms")) + " FROM verdicts GROUP BY content_id) "


@query(_WIDE + "SELECT * FROM w")
def c9_wide_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return vote.wide(verdicts(spark, d), ["violation", "category", "latency_ms"])


@query(_WIDE + "SELECT count(*) AS complete, round(avg(CASE WHEN juror_a_violation = juror_b_violation AND juror_a_violation = juror_c_violation THEN 1 ELSE 0 END), 6) AS unanimity FROM w WHERE juror_a_violation IS NOT NULL AND juror_b_violation IS NOT NULL AND juror_c_violation IS NOT NULL")
def f16_unanimity(spark: SparkSession, d: str) -> DataFrame:
    return vote.unanimity(vote.wide(verdicts(spark, d), ["violation"]))


@query(_MERGE + "SELECT language, count(*) AS both_rows, count(*) FILTER (WHERE (label_name = 'L1') = (f1 + f2 + f3 > 0)) AS mismatches FROM merged WHERE origin = 'both' GROUP BY language")
def f17_schema_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return merge.schema_mismatch(_merged(spark, d), F3, "L1")


@query("SELECT concat_ws('|', CASE WHEN f1 = 1 THEN 'f1' END, CASE WHEN f2 = 1 THEN 'f2' END, CASE WHEN f3 = 1 THEN 'f3' END) AS labels, count(*) AS n FROM flagged GROUP BY 1 ORDER BY n DESC, labels LIMIT 5")
def f18_top_combos(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).groupBy(fl.joined_flags(F3).alias("labels")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "labels").limit(5)


@query("SELECT l.label, CAST(coalesce(max(_ord), -1) + 1 AS INT) AS next_batch FROM (VALUES ('L1'), ('L2'), ('L99')) AS l(label) LEFT JOIN posts p ON p.label = l.label GROUP BY l.label")
def f19_next_batch(spark: SparkSession, d: str) -> DataFrame:
    ids = posts(spark, d).select(F.format_string("%s__batch_%04d", "label", "_ord").alias("batch_id"))
    return state.next_batch(ids, "batch_id", ["L1", "L2", "L99"])


_REASONS = """
WITH b AS (SELECT *, min(_ord) OVER (PARTITION BY key) AS first FROM fresh),
r AS (SELECT label, CASE WHEN _ord > first THEN 'in_batch' WHEN key IN (SELECT key FROM seen WHERE _ord % 2 = 0) THEN 'original'
        WHEN key IN (SELECT key FROM seen WHERE _ord % 2 = 1) THEN 'synthetic' ELSE 'accepted' END AS reason FROM b)
"""


@query(_REASONS + """
SELECT label, CAST(10 + count(*) FILTER (WHERE reason = 'in_batch') AS BIGINT) AS in_batch_count, CAST(count(*) FILTER (WHERE reason = 'original') AS BIGINT) AS original_count,
       CAST(count(*) FILTER (WHERE reason = 'synthetic') AS BIGINT) AS synthetic_count FROM r GROUP BY label
""")
def f20_rejection_counters(spark: SparkSession, d: str) -> DataFrame:
    k = tx.lower_key("clean_text")
    s = seen(spark, d).select("_ord", k.alias("key"))
    batch = dedup.classify_duplicates(fresh(spark, d).withColumn("key", k), s.where("_ord % 2 = 0"), s.where("_ord % 2 = 1"))
    prior = spark.createDataFrame([(x, 10, 0, 0) for x in LABELS], "label string, in_batch_count long, original_count long, synthetic_count long")
    return state.add_counters(prior, batch, "label", {"in_batch_count": "in_batch", "original_count": "original", "synthetic_count": "synthetic"})


@query("""
WITH c AS (SELECT label, count(DISTINCT key) AS o, CAST(substr(label, 2) AS BIGINT) AS i FROM posts GROUP BY label)
SELECT label, o + i * 3 AS final_total_count, greatest(125 - (o + i * 3), 0) AS gap_remaining,
  CASE WHEN o >= 125 THEN 'already_enough' WHEN o + i * 3 >= 125 THEN 'completed' WHEN i >= 7 THEN 'not_enough_after_retry' WHEN i % 2 = 0 THEN 'failed_parse' ELSE 'error' END AS status FROM c
""")
def f21_status(spark: SparkSession, d: str) -> DataFrame:
    c = posts(spark, d).groupBy("label").agg(F.count_distinct(*halves(tx.lower_key("clean_text"))).alias("original_unique_count"), F.substring("label", 2, 2).cast("long").alias("i"))
    r = c.select("label", "original_unique_count", (F.col("i") * 3).alias("accepted_main_count"), F.col("i").alias("retry_count"), (1 - F.col("i") % 2).alias("parse_error_count"), F.lit(0).alias("generated_request_count"))
    return state.run_status(r, 125, 7).select("label", "final_total_count", "gap_remaining", "status")


@query("SELECT coalesce(a.label, b.label) AS label, coalesce(a.n, 0) + coalesce(b.n, 0) AS total FROM (SELECT label, count(*) AS n FROM seen GROUP BY label) a FULL JOIN (SELECT label, count(*) AS n FROM fresh WHERE label <> 'L2' GROUP BY label) b ON a.label = b.label")
def f22_supplement_totals(spark: SparkSession, d: str) -> DataFrame:
    a = seen(spark, d).groupBy("label").agg(F.count("*").alias("a"))
    b = fresh(spark, d).where("label <> 'L2'").groupBy("label").agg(F.count("*").alias("b"))
    return a.join(b, "label", "full_outer").select("label", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("total"))


@query("""
SELECT _ord FROM (SELECT _ord, label, row_number() OVER (PARTITION BY label ORDER BY _ord) AS rn FROM posts) JOIN (VALUES ('L1', 3), ('L2', 40), ('L7', 11)) AS n(label, need) USING (label) WHERE rn <= need
""")
def g3_top_by_deficit(spark: SparkSession, d: str) -> DataFrame:
    need = spark.createDataFrame([("L1", 3), ("L2", 40), ("L7", 11)], "label string, need int")
    return balance.first_of_label(posts(spark, d), need, "label", 40).select("_ord")


@query("SELECT conv_id, 'c' || CAST(conv_id AS VARCHAR) || '__item_' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS VARCHAR), 2, '0') AS item_id FROM conversations")
def g7_item_ordinal(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("t"))
    return c.select("conv_id", F.posexplode("t").alias("i", "t")).select("conv_id", F.format_string("c%d__item_%02d", "conv_id", "i").alias("item_id"))


@query("SELECT _ord FROM posts ORDER BY md5(CAST(_ord AS VARCHAR) || '|42'), _ord LIMIT 60")
def h4_seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return balance.sample_up_to(posts(spark, d), 60, F.col("_ord")).select("_ord")


@query(f"SELECT _ord, {sql_norm('clean_text')} AS style FROM posts WHERE label = 'L4' ORDER BY md5(CAST(_ord AS VARCHAR) || '|7'), _ord LIMIT 8")
def h5_style_samples(spark: SparkSession, d: str) -> DataFrame:
    return balance.sample_up_to(posts(spark, d).where("label = 'L4'"), 8, F.col("_ord"), 7).select("_ord", tx.normalise("clean_text").alias("style"))


@query("SELECT label, gap, least(30, greatest(gap, 5)) AS ask FROM (SELECT label, greatest(200 - count(*), 0) AS gap FROM posts GROUP BY label) WHERE gap > 0 ORDER BY gap DESC, label LIMIT 1")
def h6_next_label(spark: SparkSession, d: str) -> DataFrame:
    return state.next_label(merge.distribution(posts(spark, d), "label", LABELS, 200), "label", "gap", LABELS, 30)


@query("""
SELECT _ord, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY _ord) <= CASE label WHEN 'L1' THEN 20 ELSE 35 END THEN 'main' ELSE 'overflow' END AS part
FROM (SELECT label, min(_ord) AS _ord FROM posts WHERE label IN ('L1', 'L2') GROUP BY label, key)
""")
def i4_main_overflow(spark: SparkSession, d: str) -> DataFrame:
    """I4 and N6: rows in order, distinct by label and key, split at each label's need."""
    p = posts(spark, d).where(F.col("label").isin("L1", "L2")).withColumn("key", tx.lower_key("clean_text"))
    return balance.split_main_overflow(p, {"L1": 20, "L2": 35}, "label", "key").select("_ord", "part")


@query("""
SELECT content_id, juror, CASE WHEN content_id % 4 = 3 THEN NULL WHEN content_id % 4 IN (1, 2) THEN FALSE ELSE violation END AS violation,
       CASE WHEN content_id % 4 > 0 THEN 'L5' WHEN violation = FALSE THEN 'L5' WHEN category = 'L5' THEN 'L1' ELSE category END AS category FROM verdicts
""")
def k4_verdict_validation(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content_id") % 4
    base = F.when(F.col("category") == "L5", "L1").otherwise(F.col("category"))
    kind = F.when(c == 1, F.lit(None).cast("string")).when(c == 2, "No_Violation").when(c == 3, "unheard of").otherwise(base)
    return vote.validated(verdicts(spark, d).withColumn("category", kind), PROFILE).select("content_id", "juror", "violation", "category")


@query(f"""
SELECT _ord, CASE WHEN {sql_norm('clean_text')} = '' THEN 'empty_clean_text' WHEN label = 'L3' THEN 'wrong_final_category'
  WHEN length({sql_norm('clean_text')}) NOT BETWEEN 40 AND 240 THEN 'bad_length_' || CAST(length({sql_norm('clean_text')}) AS VARCHAR)
  WHEN contains(' ' || lower({sql_norm('clean_text')}) || ' ', ' thing') THEN 'refusal_text' END AS reason FROM posts
""")
def l1_quality_filter(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.when(F.col("label") == "L3", "L4").otherwise(F.col("label"))
    return posts(spark, d).select("_ord", rules.rejection(F.col("clean_text"), F.col("label"), wanted, 40, 240, [" thing"]).alias("reason"))


@query(f"SELECT _ord, CASE WHEN key = '' THEN 'empty' WHEN length({sql_norm('clean_text')}) NOT BETWEEN 8 AND 800 OR contains(' ' || key || ' ', ' the thing') THEN 'invalid' END AS reason FROM posts")
def l2_invalid_text(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", rules.invalid_text(F.col("clean_text"), [" the thing"]).alias("reason"))


RULES = (
    rules.Rule("L1", "relabel", "thing_and_tion", "L8", all_of=("thing", "tion")),
    rules.Rule("L1", "drop", "eaux", all_of=("eaux",)),
    rules.Rule("L2", "drop", "no_thing", none_of=("thing",)),
    rules.Rule("L2", "relabel", "hing_beside_thing", "L7", all_of=("hing",), exempt="thing"),
    rules.Rule("L3", "keep", "l3_keep"),
)
_RULES = """
WITH dec AS (
  SELECT *, CASE WHEN source NOT IN ('src0', 'src1', 'src2') THEN 'keep' WHEN label = 'L1' AND lower(clean_text) LIKE '%thing%' AND lower(clean_text) LIKE '%tion%' THEN 'relabel'
    WHEN label = 'L1' AND lower(clean_text) LIKE '%eaux%' THEN 'drop' WHEN label = 'L2' AND lower(clean_text) NOT LIKE '%thing%' THEN 'drop'
    WHEN label = 'L2' AND replace(lower(clean_text), 'thing', ' ') LIKE '%hing%' THEN 'relabel' ELSE 'keep' END AS action,
  CASE WHEN source NOT IN ('src0', 'src1', 'src2') THEN 'real_or_original_keep' WHEN label = 'L1' AND lower(clean_text) LIKE '%thing%' AND lower(clean_text) LIKE '%tion%' THEN 'thing_and_tion'
    WHEN label = 'L1' AND lower(clean_text) LIKE '%eaux%' THEN 'eaux' WHEN label = 'L2' AND lower(clean_text) NOT LIKE '%thing%' THEN 'no_thing'
    WHEN label = 'L2' AND replace(lower(clean_text), 'thing', ' ') LIKE '%hing%' THEN 'hing_beside_thing' WHEN label = 'L3' THEN 'l3_keep' ELSE 'not_target_keep' END AS reason FROM posts)
"""


def _decision():
    return rules.decide(F.col("label"), F.col("clean_text"), RULES, F.col("source").isin("src0", "src1", "src2"))


@query(_RULES + "SELECT _ord, action, reason, CASE WHEN action = 'relabel' THEN CASE label WHEN 'L1' THEN 'L8' ELSE 'L7' END END AS new_label FROM dec")
def l3_boundary_rules(spark: SparkSession, d: str) -> DataFrame:
    """L3 and L4: one rule table, the first that fits."""
    return posts(spark, d).select("_ord", _decision().alias("x")).select("_ord", "x.*")


@query(_RULES + "SELECT _ord, CASE WHEN action = 'relabel' THEN CASE label WHEN 'L1' THEN 'L8' ELSE 'L7' END ELSE label END AS label, NOT (CASE WHEN action = 'relabel' THEN 'x' ELSE label END = 'L3') AS final_violation FROM dec WHERE action <> 'drop'")
def l5_apply_clean(spark: SparkSession, d: str) -> DataFrame:
    clean, _ = rules.apply_rules(posts(spark, d), _decision(), "label", "L3")
    return clean.select("_ord", "label", "final_violation")


@query(_RULES + "SELECT _ord, action, reason, label AS old_label, CASE action WHEN 'drop' THEN '' WHEN 'relabel' THEN CASE label WHEN 'L1' THEN 'L8' ELSE 'L7' END ELSE label END AS new_label FROM dec WHERE action <> 'keep'")
def b7_review_queue(spark: SparkSession, d: str) -> DataFrame:
    _, actions = rules.apply_rules(posts(spark, d), _decision(), "label", "L3")
    return actions.where("action <> 'keep'")


_AUDIT = _VOTE + """,
a AS (SELECT v.*, 'L' || CAST(content_id % 5 + 1 AS VARCHAR) AS current_label, CASE content_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS usable,
        CASE content_id % 3 WHEN 0 THEN 'reject' WHEN 1 THEN 'review' ELSE '' END AS audit_action, CASE content_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN '' ELSE 'low' END AS risk_level FROM voted v),
b AS (SELECT *, coalesce(usable, TRUE) AS ok, final_category = current_label AS label_match FROM a)
SELECT content_id, CASE WHEN requires_review THEN 'review' WHEN NOT label_match AND ok THEN 'review' WHEN NOT label_match THEN 'reject'
         WHEN NOT ok OR audit_action = 'reject' THEN '{0}' WHEN audit_action = 'review' OR risk_level IN ('medium', 'high') THEN 'review' ELSE 'accept' END AS action,
       CASE WHEN requires_review THEN 'medium' WHEN NOT label_match AND ok THEN 'medium' WHEN NOT label_match THEN 'high'
         WHEN NOT ok OR audit_action = 'reject' THEN coalesce(nullif(risk_level, ''), '{1}') WHEN audit_action = 'review' OR risk_level IN ('medium', 'high') THEN coalesce(nullif(risk_level, ''), 'medium')
         ELSE coalesce(nullif(risk_level, ''), 'low') END AS risk FROM b
"""


def _audit(spark: SparkSession, d: str, reject_boundary: bool) -> DataFrame:
    profile = vote.Profile(PROFILE.priority, PROFILE.neutral, reject_boundary=reject_boundary)
    i = F.col("content_id")
    v = vote.majority_vote(verdicts(spark, d), profile).withColumns({
        "current_label": F.concat(F.lit("L"), (i % 5 + 1).cast("string")), "usable": F.when(i % 4 == 0, True).when(i % 4 == 1, False),
        "audit_action": F.when(i % 3 == 0, "reject").when(i % 3 == 1, "review").otherwise(""), "risk_level": F.when(i % 5 == 0, "high").when(i % 5 == 1, "").otherwise("low"),
    })
    return v.select("content_id", vote.audit_action(profile).alias("x")).select("content_id", "x.action", "x.risk")


@query(_AUDIT.format("review", "medium"))
def l6_audit_action(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d, False)


@query(_AUDIT.format("reject", "high"))
def l6_audit_action_reject(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d, True)


@query("""
WITH c AS (SELECT label, count(*) AS total, count(*) FILTER (WHERE lower(clean_text) LIKE '%thing%') AS s1, count(*) FILTER (WHERE lower(clean_text) LIKE '%eaux%') AS s2 FROM posts GROUP BY label)
SELECT label, 's1' AS scenario, s1 AS count, total, round(s1 / total, 4) AS rate FROM c UNION ALL SELECT label, 's2', s2, total, round(s2 / total, 4) FROM c
""")
def m1_scenario_rates(spark: SparkSession, d: str) -> DataFrame:
    """M1 and M2: hits of scenarios or boundary flags by label."""
    return metrics.hit_rates(posts(spark, d), "label", "clean_text", {"s1": "thing", "s2": "eaux"})


_WORDS = """
WITH k AS (SELECT DISTINCT 'G' || CAST(item_id % 10 AS VARCHAR) AS g, lower(w) AS w FROM (SELECT item_id, unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE length(w) >= 11),
h AS (SELECT DISTINCT p._ord, p.label, k.g FROM posts p JOIN k ON contains(lower(p.clean_text), k.w))
"""


def _long_words(spark: SparkSession, d: str) -> DataFrame:
    """Keywords in ten groups: the long words of the benchmark's items."""
    w = table(spark, d, "benchmark").select(F.concat(F.lit("G"), (F.col("item_id") % 10).cast("string")).alias("group"), F.explode(F.split("text", " ")).alias("keyword"))
    return w.where(F.length("keyword") >= 11)


@query(_WORDS + "SELECT p._ord, coalesce(string_agg(h.g, ',' ORDER BY h.g), '') AS hits FROM posts p LEFT JOIN h ON h._ord = p._ord GROUP BY p._ord")
def d7_many_keywords(spark: SparkSession, d: str) -> DataFrame:
    """D7 for long lists: one pass over each text, whatever the number of keywords."""
    hit = keywords.with_hits(posts(spark, d).select("_ord", "clean_text"), "clean_text", _long_words(spark, d))
    return hit.select("_ord", F.array_join("hits", ",").alias("hits"))


@query(_WORDS + """, c AS (SELECT label, count(*) AS total FROM posts GROUP BY label)
SELECT h.label, h.g AS scenario, count(*) AS count, c.total, round(count(*) / c.total, 4) AS rate FROM h JOIN c ON c.label = h.label GROUP BY h.label, h.g, c.total
""")
def m1_keyword_rates(spark: SparkSession, d: str) -> DataFrame:
    """M1 for long lists of keywords by scenario."""
    return keywords.hit_rates(posts(spark, d), "label", "clean_text", _long_words(spark, d))


@query("""
SELECT label, count(*) AS n, round(avg(length(clean_text)), 4) AS mean_chars, round(avg(len(regexp_extract_all(clean_text, '#[\\p{L}\\p{N}_]+'))), 4) AS hashtag_per_text,
  round(avg(CASE WHEN regexp_matches(clean_text, '[\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}]') THEN 1 ELSE 0 END), 4) AS emoji_rate,
  round(avg(CASE WHEN contains(lower(clean_text), 'thing') THEN 1 ELSE 0 END), 4) AS term_rate FROM posts GROUP BY label
""")
def m3_text_metrics(spark: SparkSession, d: str) -> DataFrame:
    """M3 and M7: mean length, hashtags, emoji and term rates."""
    return metrics.text_metrics(posts(spark, d), "label", "clean_text", ["thing"])


@query("SELECT label, round(count(DISTINCT w) / count(*), 4) AS token_unique_ratio FROM (SELECT label, unnest(string_split(key, ' ')) AS w FROM posts WHERE key <> '') GROUP BY label")
def m4_unique_ratio(spark: SparkSession, d: str) -> DataFrame:
    return metrics.unique_ratio(posts(spark, d), "label", "clean_text")


def _gram_sql(n: int) -> str:
    return f"""
WITH t AS (SELECT label, string_split(key, ' ') AS t FROM posts WHERE key <> ''),
g AS (SELECT label, array_to_string(t[i:i+{n - 1}], ' ') AS g, count(*) AS n FROM t, unnest(range(1, len(t) - {n} + 2)) AS x(i) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, g) AS rn FROM g)
SELECT label, round(sum(n) FILTER (WHERE rn <= 10) / sum(n), 4) AS share FROM r GROUP BY label
"""


@query(_gram_sql(2))
def m5_bigram_share(spark: SparkSession, d: str) -> DataFrame:
    return metrics.ngram_top_share(posts(spark, d), "label", "clean_text", 2)


@query(_gram_sql(3))
def m5_trigram_share(spark: SparkSession, d: str) -> DataFrame:
    return metrics.ngram_top_share(posts(spark, d), "label", "clean_text", 3)


@query("""
WITH s AS (SELECT label, array_to_string(string_split(key, ' ')[1:4], ' ') AS s, count(*) AS n FROM posts GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, s) AS rn FROM s)
SELECT label, round(sum(n) FILTER (WHERE rn <= 10) / sum(n), 4) AS share FROM r GROUP BY label
""")
def m6_start_share(spark: SparkSession, d: str) -> DataFrame:
    return metrics.start_top_share(posts(spark, d), "label", "clean_text")


@query("""
WITH h AS (SELECT label, unnest(regexp_extract_all(lower(replace(clean_text, ' th', ' #th')), '#[\\p{L}\\p{N}_]+')) AS hashtag FROM posts),
c AS (SELECT label, hashtag, count(*) AS n FROM h GROUP BY ALL)
SELECT * FROM (SELECT label, hashtag, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, hashtag) AS rn FROM c) WHERE rn <= 30
""")
def m8_top_hashtags(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).withColumn("clean_text", F.replace("clean_text", F.lit(" th"), F.lit(" #th")))
    return metrics.top_hashtags(p, "label", "clean_text", 30)


@query("SELECT coalesce(label, 'All') AS label, count(*) FILTER (WHERE source IN ('src0', 'src1')) AS web, count(*) FILTER (WHERE source = 'src2') AS forum, count(*) FILTER (WHERE source NOT IN ('src0', 'src1', 'src2')) AS other, count(*) AS \"All\" FROM posts GROUP BY ROLLUP (label)")
def m9_source_group_crosstab(spark: SparkSession, d: str) -> DataFrame:
    p = merge.add_groups(posts(spark, d), "source", {"src0": "web", "src1": "web", "src2": "forum"})
    return merge.crosstab(p, "label", "source_group", ["web", "forum", "other"])


@query("SELECT _ord, label, rn FROM (SELECT _ord, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(_ord AS VARCHAR) || '|42'), _ord) AS rn FROM posts) WHERE rn <= 5")
def m10_review_sample(spark: SparkSession, d: str) -> DataFrame:
    return metrics.review_sample(posts(spark, d), "label", 5, "_ord").select("_ord", "label", "rn")


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0")
def n1_resume(spark: SparkSession, d: str) -> DataFrame:
    path = io.work_path(spark, "resume")
    e = table(spark, d, "events").select("event_id")
    io.upsert(spark, path, e.where("event_id % 3 = 0"), "event_id", "event_id")
    return state.remaining(e, io.read_checkpoint(spark, path, "event_id", "event_id"), "event_id")


@query("SELECT event_id % 300 AS content_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY event_id % 300")
def n2_stream_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """A stream upserted into a checkpoint, run after each of two appends to its log: one batch after another."""
    root = io.work_path(spark, "stream")
    e = table(spark, d, "events").select((F.col("event_id") % 300).alias("content_id"), "event_id", "event_type")
    for part in range(2):
        io.append_log(e.where(F.col("event_id") % 2 == part), f"{root}/log")
        log = jobs.read_log(spark, f"{root}/log", "content_id long, event_id long, event_type string", None)
        jobs.upsert_stream(log, f"{root}/state", f"{root}/checkpoint", "content_id", "event_id").awaitTermination()
    return io.read_checkpoint(spark, f"{root}/state", "content_id", "event_id")


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def n3_last_attempt(spark: SparkSession, d: str) -> DataFrame:
    return state.last_attempt(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT event_id FROM events WHERE event_id < (SELECT coalesce(min(event_id), 9e18) FROM events WHERE value > 400)")
def n4_strict_prefix(spark: SparkSession, d: str) -> DataFrame:
    return state.before_first(table(spark, d, "events").select("event_id", "value"), F.col("value") > 400, "event_id").select("event_id")


_BAL_P = f"""
WITH m AS (SELECT * FROM posts WHERE _ord % 3 = 0), need1 AS (SELECT label, greatest(110 - n, 0) AS need FROM (SELECT label, count(*) AS n FROM m GROUP BY label)),
s1 AS (SELECT _ord, label, key FROM posts WHERE _ord % 3 = 1 AND key <> '' AND trim(clean_text) NOT IN (SELECT trim(clean_text) FROM m)),
f1 AS (SELECT min(p._ord) AS _ord FROM posts p JOIN s1 USING (_ord) GROUP BY trim(p.clean_text)),
p1 AS (SELECT _ord, label FROM (SELECT p._ord, p.label, row_number() OVER (PARTITION BY p.label ORDER BY p._ord) AS rn FROM posts p JOIN f1 USING (_ord)) JOIN need1 USING (label) WHERE rn <= need),
need2 AS (SELECT label, need - coalesce(n, 0) AS need FROM need1 LEFT JOIN (SELECT label, count(*) AS n FROM p1 GROUP BY label) USING (label)),
f2 AS (SELECT min(_ord) AS _ord FROM posts WHERE _ord % 3 = 2 AND key <> '' AND trim(clean_text) NOT IN (SELECT trim(clean_text) FROM m) AND trim(clean_text) NOT IN (SELECT trim(clean_text) FROM posts JOIN p1 USING (_ord)) GROUP BY trim(clean_text)),
p2 AS (SELECT _ord, label FROM (SELECT p._ord, p.label, row_number() OVER (PARTITION BY p.label ORDER BY p._ord) AS rn FROM posts p JOIN f2 USING (_ord)) JOIN need2 USING (label) WHERE rn <= need)
SELECT _ord, label, 'pool1' AS balance_source FROM p1 UNION ALL SELECT _ord, label, 'pool2' FROM p2
"""


@query(_BAL_P.replace("'", "'"))
def n5_balance_cascade(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d)
    taken = balance.balance(p.where("_ord % 3 = 0"), [("pool1", p.where("_ord % 3 = 1")), ("pool2", p.where("_ord % 3 = 2"))], LABELS, 110, label="label")
    return taken.select("_ord", "label", "balance_source")


@query(f"""
WITH k AS (SELECT *, md5({sql_norm('clean_text')}) AS k FROM flagged),
a AS (SELECT * FROM k WHERE f1 = 1 OR f2 = 1 ORDER BY md5(k || '|42'), _ord LIMIT 45),
b AS (SELECT * FROM k WHERE f3 = 1 AND k NOT IN (SELECT k FROM a) ORDER BY md5(k || '|42'), _ord LIMIT 30),
c AS (SELECT * FROM k WHERE f4 = 1 AND k NOT IN (SELECT k FROM a) AND k NOT IN (SELECT k FROM b))
SELECT _ord, 'T1' AS target_label FROM a UNION ALL SELECT _ord, 'T2' FROM b UNION ALL SELECT _ord, 'T3' FROM c
""")
def n7_quota_select(spark: SparkSession, d: str) -> DataFrame:
    plan = [("T1", ["f1", "f2"], 30, 1.5), ("T2", ["f3"], 20, 1.5), ("T3", ["f4"], 10, 999.0)]
    return balance.quota_select(flagged(spark, d), plan, "clean_text", FLAGS).select("_ord", "target_label")


@query("SELECT label, greatest(130 - count(DISTINCT key), 0) AS gap FROM posts WHERE key <> '' GROUP BY label")
def n8_remaining_after_batch(spark: SparkSession, d: str) -> DataFrame:
    got = metrics.distinct_keys(posts(spark, d), "label", "clean_text")
    return got.select("label", F.greatest(F.lit(130) - F.col("unique_texts"), F.lit(0)).alias("gap"))


@query(f"SELECT min(_ord) AS _ord FROM posts WHERE label IN ('L1', 'L2', 'L3') AND length({sql_norm('clean_text')}) BETWEEN 40 AND 2000 GROUP BY key")
def n9_rebuild_final(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).where(F.col("label").isin(*LABELS[:3]))
    ok = p.where(rules.rejection(F.col("clean_text"), F.col("label"), F.col("label"), 40, 2000).isNull())
    return dedup.keep_first(ok, tx.lower_key("clean_text")).select("_ord")


@query(f"SELECT min(_ord) AS _ord FROM posts WHERE label IN ('L1', 'L2', 'L3') AND length({sql_norm('clean_text')}) BETWEEN 40 AND 2000 GROUP BY key")
def n9_rebuild_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream, a second a row, that runs after each of three appends to its log, which come in order."""
    root = io.work_path(spark, "rebuild")
    p = posts(spark, d).select("_ord", "clean_text", "label", F.timestamp_seconds("_ord").alias("at"))
    top = (p.agg(F.max("_ord")).first()[0] or 0) + 1
    valid = lambda r: r.where(F.col("label").isin(*LABELS[:3]) & rules.rejection(F.col("clean_text"), F.col("label"), F.col("label"), 40, 2000).isNull())
    for part in range(3):
        io.append_log(p.where((F.col("_ord") * 3 >= part * top) & (F.col("_ord") * 3 < (part + 1) * top)), f"{root}/log")
        log = jobs.read_log(spark, f"{root}/log", "_ord long, clean_text string, label string, at timestamp", None)
        jobs.rebuild_stream(log, valid, "clean_text", "_ord", "at", float(top), root).awaitTermination()
    rows = jobs.sunk(spark, root)
    return (rows if rows is not None else p.limit(0)).select("_ord")


@query(_REASONS + "SELECT reason, count(*) AS n FROM r GROUP BY reason")
def n10_sanitise(spark: SparkSession, d: str) -> DataFrame:
    k = tx.lower_key("clean_text")
    s = seen(spark, d).select("_ord", k.alias("key"))
    out = dedup.classify_duplicates(fresh(spark, d).withColumn("key", k), s.where("_ord % 2 = 0"), s.where("_ord % 2 = 1"))
    return out.groupBy("reason").agg(F.count("*").alias("n"))


@query("""
SELECT count(*) FILTER (WHERE key = '') AS empty_text, count(*) FILTER (WHERE label NOT IN ('L1', 'L2', 'L3', 'L4')) AS bad_label, count(*) - count(DISTINCT key) AS repeated_key,
       count(*) FILTER (WHERE key IN (SELECT key FROM seen)) AS in_original FROM fresh
""")
def n11_invariants(spark: SparkSession, d: str) -> DataFrame:
    return balance.violations(fresh(spark, d), seen(spark, d), LABELS[:4], "label", "clean_text", tx.lower_key)


@query("SELECT _ord, language FROM posts ORDER BY _ord LIMIT 5")
def n12_preview(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).orderBy("_ord").limit(5).select("_ord", "language")


@query("""
SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
""")
def crosstab_scale(spark: SparkSession, d: str) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation")).agg(F.count("*").alias("n"))



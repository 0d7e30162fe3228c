"""Queries of scans, projections, filters, joins and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flags as fl
from ..functions import text as tx
from ..functions.keys import halves
from ..operators import dedup
from ..sources import tables as io
from ..streaming import jobs
from ._base import FLAGS, LABELS, SPELLINGS, Registry, flagged, fresh, posts, seen, sql_key, sql_norm, table

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def KEY():
    return tx.lower_key("clean_text")


@query("""
WITH u AS (SELECT key, arg_min(language, _ord) AS language FROM fresh WHERE key NOT IN (SELECT key FROM seen WHERE key <> '') GROUP BY key)
SELECT language, count(*) AS distinct_unseen, greatest(0, 200 - count(*)) AS still_needed FROM u GROUP BY language
""")
def flagship_need(spark: SparkSession, d: str) -> DataFrame:
    """How many more distinct, unseen documents each language needs to reach 200."""
    h1, h2 = halves(KEY())
    first = fresh(spark, d).select(h1.alias("h1"), h2.alias("h2"), F.struct("_ord", "language").alias("x")).groupBy("h1", "h2").agg(F.min("x").alias("x"))
    u = first.join(dedup.key_hashes(seen(spark, d), KEY()), ["h1", "h2"], "left_anti").select("x.language")  # no text leaves a scan
    return u.groupBy("language").agg(F.count("*").alias("distinct_unseen"), F.greatest(F.lit(200) - F.count("*"), F.lit(0)).alias("still_needed"))


def _csv(spark: SparkSession, d: str) -> str:
    path = io.work_path(spark, "csv")
    io.write_csv(posts(spark, d).select("_ord", "clean_text", F.when(F.col("_ord") % 4 == 0, "NA").when(F.col("_ord") % 4 == 1, "").otherwise(F.col("source")).alias("source")), path)
    return path


@query("SELECT CAST(_ord AS VARCHAR) AS _ord, clean_text, CASE _ord % 4 WHEN 0 THEN 'NA' WHEN 1 THEN NULL ELSE source END AS source FROM posts")
def a1_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    return io.read_csv(spark, _csv(spark, d))


@query("SELECT _ord, clean_text, CASE WHEN _ord % 4 > 1 THEN source END AS source FROM posts")
def a2_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    return io.read_csv_inferred(spark, _csv(spark, d), {"_ord": "bigint"})


@query("SELECT CAST(_ord AS VARCHAR) AS _ord, clean_text, CASE _ord % 4 WHEN 0 THEN 'NA' WHEN 1 THEN '' ELSE source END AS source FROM posts")
def a3_csv_all_strings(spark: SparkSession, d: str) -> DataFrame:
    return io.read_csv_strict_strings(spark, _csv(spark, d))


@query("SELECT * FROM documents")
def a4_parquet_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("SELECT doc_id, lang FROM documents")
def a5_format_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return io.read_any(spark, f"{d}/documents.parquet").select("doc_id", "lang")


@query("SELECT doc_id, source FROM documents")
def a6_column_pruned(spark: SparkSession, d: str) -> DataFrame:
    return io.read_pruned(spark, f"{d}/documents.parquet", ["doc_id", "source", "absent"])


@query("SELECT doc_id, lang FROM documents")
def a7_missing_scan(spark: SparkSession, d: str) -> DataFrame:
    """A table that is there beside one that isn't."""
    both = [io.read_or_empty(spark, f"{d}/{name}.parquet", ["doc_id", "lang"]).select("doc_id", "lang") for name in ("documents", "no_such_table")]
    return both[0].unionByName(both[1].withColumn("doc_id", F.col("doc_id").cast("long")))


@query("SELECT label, count(*) AS n FROM posts WHERE label NOT IN ('L1', 'L2', 'L3') GROUP BY label")
def a8_strict_scan(spark: SparkSession, d: str) -> DataFrame:
    io.read_required(spark, f"{d}/documents.parquet", ["doc_id", "text"])
    return io.unknown_labels(posts(spark, d), "label", LABELS[:3])


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, '' AS parse_error, lang FROM documents")
def a9_pad_project(spark: SparkSession, d: str) -> DataFrame:
    return fl.padded(table(spark, d, "documents").withColumn("doc_id", F.col("doc_id").cast("string")), ["doc_id", "parse_error", "lang"], "")


@query("""
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(NULL AS BIGINT) AS doc_id, 'benchmark' AS origin FROM benchmark
UNION ALL SELECT NULL, doc_id, 'labels' FROM labels
""")
def a10_multi_path(spark: SparkSession, d: str) -> DataFrame:
    df, _ = io.read_many(spark, [f"{d}/benchmark.parquet", f"{d}/absent.parquet", f"{d}/labels.parquet"])
    return df.select("item_id", "doc_id", F.regexp_extract("source_file", r"(\w+)\.parquet", 1).alias("origin"))


@query("SELECT _ord, label, 2 AS version FROM posts")
def a11_latest_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    root = io.work_path(spark, "found")
    p = posts(spark, d).select("_ord", "label")
    for v, rows in ((1, p.where("label = 'L1'")), (2, p)):
        rows.withColumn("version", F.lit(v)).write.parquet(f"{root}/run_{v}.parquet")
    return spark.read.parquet(io.latest(spark, f"{root}/run_*.parquet"))


@query("SELECT _ord, 'policy: P1 label=' || label || ' text=' || clean_text AS prompt FROM posts")
def a12_template(spark: SparkSession, d: str) -> DataFrame:
    t = tx.substitute("policy: {{POLICY}} label={label} text={text}", {"{{POLICY}}": F.lit("P1"), "{label}": F.col("label"), "{text}": F.col("clean_text")})
    return posts(spark, d).select("_ord", t.alias("prompt"))


@query("SELECT language, count(*) AS n FROM posts GROUP BY language")
def b1_csv_with_bom(spark: SparkSession, d: str) -> DataFrame:
    c = posts(spark, d).groupBy("language").agg(F.count("*").alias("n"))
    path = io.export_csv_with_bom(c, io.work_path(spark, "bom"), ["language", "n"])
    return io.read_csv(spark, path).select("language", F.col("n").cast("long").alias("n"))


@query("SELECT CAST(_ord AS VARCHAR) AS _ord, clean_text FROM posts")
def b2_csv_overwrite(spark: SparkSession, d: str) -> DataFrame:
    path = io.work_path(spark, "csv")
    io.write_csv(posts(spark, d).limit(1), path, ["_ord", "clean_text"])
    io.write_csv(posts(spark, d), path, ["_ord", "clean_text"])
    return io.read_csv(spark, path)


@query("SELECT _ord, label FROM posts")
def b3_parquet_write(spark: SparkSession, d: str) -> DataFrame:
    path = io.work_path(spark, "pq")
    posts(spark, d).select("_ord", "label").write.mode("overwrite").parquet(path)
    return io.read_any(spark, path)


@query("SELECT _ord, label FROM fresh UNION ALL SELECT _ord, label FROM seen")
def b4_append_log(spark: SparkSession, d: str) -> DataFrame:
    path = io.work_path(spark, "log")
    for part in (fresh(spark, d), seen(spark, d)):
        io.append_log(part.select("_ord", "label"), path)
    return spark.read.parquet(path)


@query("""
SELECT event_id % 500 AS content_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       CASE WHEN max(event_id) % 2 = 1 THEN arg_max(value, event_id) END AS extra
FROM events GROUP BY event_id % 500
""")
def b5_checkpoint_upsert(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select((F.col("event_id") % 500).alias("content_id"), "event_id", "event_type", "value")
    path = io.work_path(spark, "ckpt")
    io.upsert(spark, path, e.where("event_id % 2 = 0").drop("value"), "content_id", "event_id")
    return io.upsert(spark, path, e.where("event_id % 2 = 1").withColumnRenamed("value", "extra"), "content_id", "event_id")


@query("SELECT m._ord, m.clean_text, m.label FROM posts m")
def b6_split_output(spark: SparkSession, d: str) -> DataFrame:
    root = io.work_path(spark, "split")
    io.write_split(posts(spark, d), f"{root}/main", ["_ord", "clean_text"], f"{root}/side", ["_ord", "label"])
    return spark.read.parquet(f"{root}/main").join(spark.read.parquet(f"{root}/side"), "_ord")


@query("SELECT _ord, clean_text AS text FROM posts")
def c1_alias_column(spark: SparkSession, d: str) -> DataFrame:
    return fl.with_alias(posts(spark, d), "text", ["body", "clean_text"]).select("_ord", "text")


@query("SELECT _ord, language, 'XX' AS country FROM posts")
def c2_default_columns(spark: SparkSession, d: str) -> DataFrame:
    return fl.with_defaults(posts(spark, d), {"country": "XX", "language": "zz"}).select("_ord", "language", "country")


@query("SELECT 'br_train_' || lpad(CAST(_ord AS VARCHAR), 8, '0') AS content_id FROM posts WHERE language = 'de'")
def c3_synthetic_id(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).withColumn("content_id", fl.made_id("br_train_", "_ord")).where("language = 'de'").select("content_id")


@query("SELECT _ord, CASE WHEN _ord % 5 = 0 THEN 'row_' || lpad(CAST(_ord AS VARCHAR), 8, '0') ELSE 'id' || CAST(_ord AS VARCHAR) END AS content_id FROM posts")
def c4_fill_blank_id(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).withColumn("content_id", F.when(F.col("_ord") % 5 != 0, F.concat(F.lit("id"), F.col("_ord").cast("string"))).when(F.col("_ord") % 10 == 0, "  "))
    return fl.fill_blank_id(p, "content_id", "row_", "_ord").select("_ord", "content_id")


@query("SELECT 'br_new_' || lpad(CAST(_ord * 3 AS VARCHAR), 8, '0') AS content_id FROM posts")
def c5_source_index_id(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select(fl.made_id("br_new_", F.col("_ord") * 3).alias("content_id"))


@query("SELECT _ord, CASE label WHEN 'L1' THEN 'Q1' WHEN 'L2' THEN 'Q2' ELSE label END AS label FROM posts")
def c6_value_remap(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", fl.remap(F.concat(F.lit(" "), F.col("label"), F.lit(" ")), {"L1": "Q1", "L2": "Q2"}).alias("label"))


@query("SELECT _ord, left(clean_text, 300) AS short FROM posts")
def c7_truncate(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", F.left("clean_text", F.lit(300)).alias("short"))


@query("SELECT _ord, coalesce(CASE WHEN _ord % 3 = 0 THEN clean_text END, CASE WHEN _ord % 3 = 1 THEN source END, language) AS text FROM posts")
def c8_fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).withColumns({"a": F.when(F.col("_ord") % 3 == 0, F.col("clean_text")).otherwise(""), "b": F.when(F.col("_ord") % 3 == 1, F.col("source"))})
    return p.select("_ord", fl.first_filled("a", "b", "language").alias("text"))


@query("SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS DOUBLE), 0) AS x FROM events")
def c10_coercing_cast(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", fl.to_number(F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))).alias("x"))


@query("SELECT _ord, CASE WHEN _ord % 9 < 5 THEN 1 ELSE 0 END AS flag FROM posts")
def c11_to_binary(spark: SparkSession, d: str) -> DataFrame:
    spelled = F.element_at(F.array(*[F.lit(x) for x in SPELLINGS]), (F.col("_ord") % 9 + 1).cast("int"))
    return posts(spark, d).select("_ord", fl.to_binary(spelled).alias("flag"))


@query("SELECT _ord, concat_ws('|', CASE WHEN f1 = 1 THEN 'f1' END, CASE WHEN f2 = 1 THEN 'f2' END, CASE WHEN f3 = 1 THEN 'f3' END) AS labels FROM flagged")
def c12_joined_flags(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).select("_ord", fl.joined_flags(FLAGS[:3]).alias("labels"))


@query("SELECT _ord, f1 + f2 + f3 + f4 + f5 + f6 + f7 AS n_flags FROM flagged")
def c13_flag_count(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).select("_ord", fl.count_flags(FLAGS).alias("n_flags"))


@query("SELECT _ord, language, CAST(NULL AS VARCHAR) AS confidence FROM posts")
def c14_reindex(spark: SparkSession, d: str) -> DataFrame:
    return fl.padded(posts(spark, d), ["_ord", "language", "confidence"])


@query("SELECT _ord AS original_index, clean_text AS body FROM posts")
def c15_rename_drop(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).withColumnsRenamed({"_ord": "original_index", "clean_text": "body"}).select("original_index", "body")


@query("SELECT _ord, 'pool' AS balance_source, 'pool.csv' AS balance_source_file FROM posts")
def c16_provenance(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", F.lit("pool").alias("balance_source"), F.lit("pool.csv").alias("balance_source_file"))


@query(f"SELECT label || '__' || md5(label || chr(31) || {sql_norm('clean_text')}) AS content_id, clean_text AS text, label AS llm_label, 'gen' AS source, 'synthetic' AS origin, 'ok' AS sample_quality FROM posts")
def c17_output_row(spark: SparkSession, d: str) -> DataFrame:
    return fl.output_row(posts(spark, d), "label", "clean_text", "gen")


@query("SELECT _ord, CASE WHEN label = 'L1' THEN 'safe' ELSE label END AS final_category, label <> 'L1' AS final_violation FROM posts")
def c18_paired_update(spark: SparkSession, d: str) -> DataFrame:
    return fl.set_label(posts(spark, d), F.when(F.col("label") == "L1", "safe").otherwise(F.col("label"))).select("_ord", "final_category", "final_violation")


@query("SELECT _ord, CASE WHEN _ord % 2 = 0 THEN clean_text ELSE '' END AS body FROM posts")
def c19_fill_text(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", F.when(F.col("_ord") % 2 == 0, F.col("clean_text")).alias("body")).fillna("", ["body"])


@query("SELECT _ord FROM posts WHERE key <> '' AND _ord % 7 <> 0")
def d1_not_blank(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d).withColumn("t", F.when(F.col("_ord") % 7 == 0, F.when(F.col("_ord") % 2 == 0, " \t ")).otherwise(F.col("clean_text")))
    return p.where(~tx.is_blank("t")).select("_ord")


@query("SELECT doc_id FROM documents WHERE lang IN ('de', 'fr')")
def d2_in_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("lang").isin("de", "fr")).select("doc_id")


@query("SELECT _ord FROM posts WHERE label = 'L3'")
def d3_label_equal(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).where("label = 'L3'").select("_ord")


@query("SELECT _ord, f2 = 1 OR f4 = 1 AS any_flag, f1 + f2 + f3 + f4 + f5 + f6 + f7 = 0 AS none_set FROM flagged")
def d4_any_flags(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).select("_ord", fl.any_flag(["f2", "f4"]).alias("any_flag"), (~fl.any_flag(FLAGS)).alias("none_set"))


@query("SELECT _ord FROM flagged WHERE f1 = 1 AND (f2 = 1 OR f3 = 1) AND NOT f4 = 1")
def d5_mask_algebra(spark: SparkSession, d: str) -> DataFrame:
    m = {f: F.col(f) == 1 for f in FLAGS}
    return flagged(spark, d).where(m["f1"] & (m["f2"] | m["f3"]) & ~m["f4"]).select("_ord")


@query("SELECT _ord FROM posts WHERE regexp_matches(clean_text, '(?i)thing')")
def d6_regex(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).where(tx.matches_any("clean_text", ["thing"])).select("_ord")


@query("""
SELECT _ord, concat_ws(',', CASE WHEN regexp_matches(clean_text, '(?i)thing|ever') THEN 'K1' END,
       CASE WHEN regexp_matches(clean_text, '(?i)mente|ción') THEN 'K2' END, CASE WHEN regexp_matches(clean_text, '(?i)eaux') THEN 'K3' END) AS hits
FROM posts
""")
def d7_keyword_recall(spark: SparkSession, d: str) -> DataFrame:
    words = {"K1": ["thing", "ever"], "K2": ["mente", "ción"], "K3": ["eaux"]}
    return posts(spark, d).select("_ord", F.concat_ws(",", *[F.when(tx.matches_any("clean_text", p), k) for k, p in words.items()]).alias("hits"))


@query("SELECT _ord FROM posts WHERE regexp_matches(clean_text, '(?i)thing') AND regexp_matches(clean_text, '(?i)tion')")
def d8_conjunction(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).where(tx.matches_any("clean_text", ["thing"]) & tx.matches_any("clean_text", ["tion"])).select("_ord")


@query("SELECT _ord FROM posts WHERE NOT contains(lower(clean_text), 'eaux') AND regexp_matches(replace(clean_text, 'thing', ' '), '(?i)hing')")
def d9_exemption(spark: SparkSession, d: str) -> DataFrame:
    stripped = F.regexp_replace("clean_text", "thing", " ")
    return posts(spark, d).where(~F.lower("clean_text").contains("eaux") & tx.matches_any(stripped, ["hing"])).select("_ord")


@query("SELECT _ord FROM posts WHERE length(clean_text) BETWEEN 40 AND 240")
def d10_length_range(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).where(tx.code_points("clean_text").between(40, 240)).select("_ord")


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)")
def d11_null_subset(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").dropna(subset=["quality"]).select("doc_id", "quality")


@query("SELECT event_id FROM events WHERE event_id % 4 <> 0")
def d12_parse_errors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("parse_error", F.when(F.col("event_id") % 4 == 0, "bad").otherwise(" "))
    return e.where(F.trim("parse_error") == "").select("event_id")


@query("SELECT _ord, label FROM posts WHERE label IN ('L1', 'L5')")
def d13_targets(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).where(F.col("label").isin("L1", "L5")).select("_ord", "label")


@query("SELECT _ord FROM fresh WHERE key NOT IN (SELECT key FROM seen WHERE key <> '')")
def e1_exclude_seen(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exclude(fresh(spark, d), seen(spark, d), "clean_text").select("_ord")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def e2_resume(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exclude_ids(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id").select("doc_id")


@query(f"SELECT _ord FROM fresh WHERE {sql_norm('clean_text')} NOT IN (SELECT {sql_norm('clean_text')} FROM seen WHERE key <> '')")
def e4_reference_keys(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exclude(fresh(spark, d), seen(spark, d), "clean_text", key=tx.normalise).select("_ord")


_E5 = """
WITH b AS (SELECT *, min(_ord) OVER (PARTITION BY key) AS first FROM fresh),
r AS (SELECT _ord, CASE WHEN _ord > first THEN 'in_batch' WHEN key IN (SELECT key FROM seen WHERE _ord % 2 = 0) THEN 'original'
        WHEN key IN (SELECT key FROM seen WHERE _ord % 2 = 1) THEN 'synthetic' ELSE 'accepted' END AS reason FROM b)
"""


@query(_E5 + "SELECT _ord, reason FROM r")
def e5_duplicate_classes(spark: SparkSession, d: str) -> DataFrame:
    s = seen(spark, d).select("_ord", KEY().alias("key"))
    out = dedup.classify_duplicates(fresh(spark, d).withColumn("key", KEY()), s.where("_ord % 2 = 0"), s.where("_ord % 2 = 1"))
    return out.select("_ord", "reason")


@query("""
SELECT s._ord FROM (SELECT * FROM fresh WHERE _ord % 2 = 1) s
WHERE key NOT IN (SELECT key FROM seen) AND key NOT IN (SELECT key FROM fresh WHERE _ord % 2 = 0)
""")
def e6_staged_exclusion(spark: SparkSession, d: str) -> DataFrame:
    f = fresh(spark, d)
    taken = seen(spark, d).unionByName(f.where("_ord % 2 = 0"))
    return dedup.exclude(f.where("_ord % 2 = 1"), taken, "clean_text").select("_ord")


@query("""
SELECT _ord, t.target FROM flagged, (VALUES ('f1', 'T1'), ('f1', 'T2'), ('f2', 'T2'), ('f3', 'T3')) AS t(flag, target)
WHERE (t.flag = 'f1' AND f1 = 1) OR (t.flag = 'f2' AND f2 = 1) OR (t.flag = 'f3' AND f3 = 1)
""")
def e7_config_lookup(spark: SparkSession, d: str) -> DataFrame:
    cfg = spark.createDataFrame([("f1", "T1"), ("f1", "T2"), ("f2", "T2"), ("f3", "T3")], "flag string, target string")
    long = flagged(spark, d).select("_ord", F.explode(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in FLAGS])).alias("flag"))
    return long.join(F.broadcast(cfg), "flag").select("_ord", "target")  # cfg is the literal above


@query("SELECT _ord FROM posts WHERE key NOT IN (SELECT key FROM posts WHERE _ord % 5 = 0)")
def e8_remove_keys(spark: SparkSession, d: str) -> DataFrame:
    p = posts(spark, d)
    return dedup.exclude(p, p.where("_ord % 5 = 0"), "clean_text").select("_ord")


@query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def e9_sidecar_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")


@query("SELECT min(_ord) AS _ord, arg_min(source, _ord) AS source FROM posts GROUP BY key")
def g1_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(posts(spark, d), KEY()).select("_ord", "source")


@query("SELECT max(_ord) AS _ord, arg_max(source, _ord) AS source FROM posts GROUP BY key")
def g2_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_last(posts(spark, d), KEY()).select("_ord", "source")


@query("""
SELECT DISTINCT _ord FROM (
  SELECT _ord, row_number() OVER (PARTITION BY f ORDER BY _ord) AS rn
  FROM (SELECT _ord, 'f1' AS f FROM flagged WHERE f1 = 1 UNION ALL SELECT _ord, 'f2' FROM flagged WHERE f2 = 1 UNION ALL SELECT _ord, 'f3' FROM flagged WHERE f3 = 1)
) WHERE rn <= 100
""")
def g4_cap_per_flag(spark: SparkSession, d: str) -> DataFrame:
    return dedup.cap_per_flag(flagged(spark, d), FLAGS[:3], 100).select("_ord")


@query("SELECT count(*) - count(DISTINCT key) AS duplicates FROM posts")
def g5_duplicate_count(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_count(posts(spark, d), KEY())


@query("""
WITH g AS (SELECT event_id, value < 40 AS bad, sum(CASE WHEN value < 40 THEN 0 ELSE 1 END) OVER (ORDER BY event_id) AS island FROM events),
n AS (SELECT event_id, row_number() OVER (PARTITION BY island ORDER BY event_id) AS n FROM g WHERE bad)
SELECT min(event_id) AS stop_at FROM n WHERE n = 5
""")
def g6_run_detector(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_failures(table(spark, d, "events"), F.col("value") < 40, 5, "event_id")


_BREAK = """
WITH g AS (SELECT event_id, value < 40 AS bad, sum(CASE WHEN value < 40 THEN 0 ELSE 1 END) OVER (ORDER BY event_id) AS island FROM events),
r AS (SELECT min(event_id) AS start FROM g WHERE bad GROUP BY island HAVING count(*) >= 9)
SELECT event_id, value FROM events WHERE event_id < coalesce((SELECT min(start) FROM r), 9e18)
"""


@query(_BREAK)
def g6_breaker(spark: SparkSession, d: str) -> DataFrame:
    """The rows kept: those before the failed run, which is dropped."""
    return dedup.until_failures(table(spark, d, "events").select("event_id", "value"), F.col("value") < 40, 9, "event_id")


@query(_BREAK)
def g6_breaker_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream that runs after each of four appends to its log, with a run that may go over their ends."""
    root = io.work_path(spark, "breaker")
    e = table(spark, d, "events").select("event_id", "value")
    top = (e.agg(F.max("event_id")).first()[0] or 0) + 1
    rows, tripped = None, False
    for part in range(4):
        if not tripped:
            io.append_log(e.where((F.col("event_id") * 4 >= part * top) & (F.col("event_id") * 4 < (part + 1) * top)), f"{root}/log")
            log = jobs.read_log(spark, f"{root}/log", "event_id long, value double", None)
            rows, tripped = jobs.breaker_rows(jobs.breaker_stream(log, F.col("value") < 40, 9, "event_id", root), spark, root)
    return rows if rows is not None else e.limit(0)


@query("SELECT _ord FROM posts ORDER BY _ord LIMIT 25")
def h1_limit(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).orderBy("_ord").limit(25).select("_ord")


@query("SELECT _ord FROM (SELECT _ord, f1 + f2 + f3 + f4 + f5 + f6 + f7 AS n, length(clean_text) AS c FROM flagged) ORDER BY n DESC, c DESC, _ord")
def h2_two_key_sort(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).orderBy(F.desc(fl.count_flags(FLAGS)), F.desc(F.length("clean_text")), "_ord").select("_ord")


@query("SELECT source, count(*) AS n FROM posts GROUP BY source ORDER BY n DESC, source")
def h3_count_name_sort(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey")
def h7_index_sorted_union(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey")
    return o.where("o_orderkey % 2 = 0").union(o.where("o_orderkey % 2 = 1")).orderBy("o_orderkey")


@query("SELECT _ord, label, CAST(NULL AS VARCHAR) AS balance_source FROM seen UNION ALL SELECT _ord, label, 'pool' FROM fresh")
def i1_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    a, b = seen(spark, d).select("_ord", "label"), fresh(spark, d).select("label", "_ord", F.lit("pool").alias("balance_source"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT _ord FROM flagged WHERE f1 = 1 UNION SELECT _ord FROM flagged WHERE regexp_matches(clean_text, '(?i)thing')")
def i2_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    f = flagged(spark, d)
    return f.where((F.col("f1") == 1) | tx.matches_any("clean_text", ["thing"])).select("_ord")


@query("SELECT DISTINCT label FROM posts WHERE label NOT IN ('L1', 'L2')")
def i3_except_labels(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("label").subtract(spark.createDataFrame([("L1",), ("L2",)], "label string"))


@query(f"SELECT _ord, {sql_norm('clean_text')} AS j1, {sql_key('clean_text')} AS j2, trim(clean_text) AS j3, md5({sql_norm('clean_text')}) AS j4, length(clean_text) AS j5 FROM posts")
def j1_text_keys(spark: SparkSession, d: str) -> DataFrame:
    """J1 to J5: the four keys and the length in code points."""
    return posts(spark, d).select("_ord", tx.normalise("clean_text").alias("j1"), KEY().alias("j2"), tx.strip_key("clean_text").alias("j3"), tx.md5_key("clean_text").alias("j4"), tx.code_points("clean_text").cast("long").alias("j5"))


_HEUR = "' ' || lower(trim(clean_text)) || ' '"


@query(f"""
SELECT _ord, len(regexp_extract_all('漢' || clean_text || '字', '[\\x{{4e00}}-\\x{{9fff}}]')) >= 2 AS cjk,
  contains({_HEUR}, ' of thing') OR (len(regexp_extract_all(clean_text, '[\\x00-\\x7f]')) / length(clean_text) > 0.94
    AND CAST(contains({_HEUR}, ' the ') AS INT) + CAST(contains({_HEUR}, ' of ') AS INT) + CAST(contains({_HEUR}, ' and ') AS INT) + CAST(contains({_HEUR}, ' in ') AS INT) >= 3
    AND CAST(contains({_HEUR}, ' que ') AS INT) = 0) AS foreign_reply,
  contains({_HEUR}, 'then thing') OR contains({_HEUR}, ' is the ') AS refusal,
  regexp_full_match(trim(clean_text), '(?i)https?://\\S+|www\\.\\S+|\\[?link\\]?') AS url_only,
  NOT regexp_matches(clean_text, '{tx.LETTER_OR_DIGIT}') AS symbol_only,
  {' OR '.join(f"regexp_matches(clean_text, '(?i){p}')" for p in tx.REAL_ARTIFACTS + tx.OPERATIONAL_ARTIFACTS)} AS artifact
FROM (SELECT _ord, coalesce(clean_text, '') AS clean_text FROM posts)
""")
def j6_text_heuristics(spark: SparkSession, d: str) -> DataFrame:
    """J6 to J8, and J10 and J11 over plain posts: CJK-heavy, foreign reply, refusal, URL only, symbols only, artifacts."""
    return posts(spark, d).select(
        "_ord", tx.cjk_heavy(F.concat(F.lit("漢"), F.col("clean_text"), F.lit("字"))).alias("cjk"),
        tx.foreign_reply("clean_text", [" of thing"], [" the ", " of ", " and ", " in "], [" que "]).alias("foreign_reply"),
        tx.contains_any("clean_text", ["then thing", " is the "]).alias("refusal"), tx.url_only("clean_text").alias("url_only"),
        tx.symbol_only("clean_text").alias("symbol_only"), tx.has_artifact("clean_text").alias("artifact"),
    )


@query("SELECT _ord, replace(clean_text, 'tion', 'sion') AS t FROM posts")
def j12_phrase_replace(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("_ord", F.regexp_replace("clean_text", "tion", "sion").alias("t"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct([source, lang, source])), '|') AS joined FROM documents")
def j13_sorted_set(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", fl.sorted_set(F.array("source", "lang", "source")).alias("joined"))


@query("SELECT _ord, CASE WHEN f1 = 1 AND f2 = 1 THEN 'both' WHEN f1 = 1 THEN 'old_label' WHEN f2 = 1 THEN 'keyword' END AS recall_method FROM flagged")
def j14_recall_method(spark: SparkSession, d: str) -> DataFrame:
    old, kw = F.col("f1") == 1, F.col("f2") == 1
    return flagged(spark, d).select("_ord", F.when(old & kw, "both").when(old, "old_label").when(kw, "keyword").alias("recall_method"))


@query("SELECT lpad(CAST(doc_id AS VARCHAR), 6, '0') || '__item_' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS item_id FROM documents")
def j15_formatted_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.format_string("%06d__item_%02d", F.col("doc_id"), F.col("doc_id") % 100).alias("item_id"))


@query("SELECT doc_id, CAST(trunc(n_chars * 1.7) AS BIGINT) AS n, CAST(ceil(n_chars / 7) AS BIGINT) AS up, least(greatest(n_chars, 50), 500) AS clamped FROM documents")
def j16_integers(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, d, "documents").select("doc_id", (n * F.lit(1.7).cast("decimal(2,1)")).cast("long").alias("n"), F.ceil(n / 7).alias("up"), F.least(F.greatest(n, F.lit(50)), F.lit(500)).alias("clamped"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS b FROM documents")
def j18_parse_bool(spark: SparkSession, d: str) -> DataFrame:
    s = F.element_at(F.array(F.lit(" True"), F.lit("FALSE"), F.lit("maybe"), F.lit(None).cast("string")), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", fl.parse_bool(s).alias("b"))

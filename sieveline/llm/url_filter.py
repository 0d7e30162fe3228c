"""URL filters: rules by host and path, and a path-template tree for what no rule reaches.

A url belongs to the longest rule that fits it: a rule's host is the url's or stands at its end after a dot, and the url's path
starts with the rule's. Urls that no rule reaches are judged by the tree of their host:

- Distinct paths. Digits in a segment become {n}, long hexadecimal segments {x}; a path of more than DEPTH segments ends in **.
  From here on there is one row for each host and generalised path, with counts of urls and of labelled ones.
- Templates, level by level from the root. A child with fewer than COMMON urls is rare; where a node has KIDS rare children or
  more, that segment is variable and all its rare children become one, `*`. Common children keep their names.
- Merging. A child whose share of labelled bad urls doesn't differ from that of its siblings taken together (two proportions,
  |z| < Z; a child without labels never does) is merged with all such siblings: they have one purity, of their sums.
- Smoothed purity, from the root down: (bad + WEIGHT * purity of the parent) / (labelled + WEIGHT), where a host's parent is
  the whole corpus. A template of purity REJECT or more is rejected.

Labels are what the rules say, or a column of the caller's. All is DataFrame expressions. Counts are hash aggregates with
map-side combining; what a hot host has of rows meets only the rejected paths, of which every one of SALTS parts has a copy. The
loop over levels is as long as the deepest path, DEPTH + 1 at most, and each level is written before the next is counted.

Defined results: a url that is null or has no :// has an empty host and path and is a template of its own; no labels at all
allow everything; equal urls and repeated rows stay rows of their own; null ids are carried; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import Work

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
DEPTH, KIDS, COMMON = 6, 16, 8
Z, WEIGHT, REJECT, SALTS = 1.96, 10.0, 0.5, 16


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no ://."""
    url = F.coalesce(url, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(url, URL, 1), upper, upper.lower()), F.regexp_extract(url, URL, 2)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as struct<size, host_size, rule, verdict>, the longer host on ties; null for none. Rules are a
    list of the caller's and part of the plan: some hundreds."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(len(r.host)).alias("host_size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size int, host_size int, rule string, verdict string>")


def shape(path: Column) -> Column:
    """The segments of a path, generalised, as an array of DEPTH + 1 at most."""
    one = lambda s: F.when(s.rlike("^[0-9a-fA-F-]{16,}\\z"), "{x}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))
    every = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), one)
    return F.when(F.size(every) > DEPTH, F.concat(F.slice(every, 1, DEPTH), F.array(F.lit("**")))).otherwise(every)


def _grown(paths: DataFrame, work: Work) -> DataFrame:
    """paths (host, segs, n, labelled, bad) with `at`: the template's nodes from the root's children down, as an array."""
    deepest = paths.agg(F.max(F.size("segs"))).first()[0] or 0
    rows = paths.withColumns({"at": F.array().cast("array<string>"), "node": F.lit("")})
    for level in range(deepest):
        rows = rows.withColumn("seg", F.try_element_at("segs", F.lit(level + 1)))
        kids = work.keep(rows.where("seg IS NOT NULL").groupBy("host", "node", "seg").agg(F.sum("n").alias("kid")).where(F.col("kid") < COMMON), f"rare{level}")
        # every salt has its own copy of the few variable nodes, so that the rare children of one node spread
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        variable = kids.groupBy("host", "node").agg(F.count("*").alias("kids")).where(F.col("kids") >= KIDS).select("host", "node", salts)
        rare = kids.withColumn("salt", F.pmod(F.xxhash64("seg"), F.lit(SALTS)).cast("int")).join(variable, ["host", "node", "salt"]).select("host", "node", "seg", F.lit(True).alias("rare"))
        name = F.when(F.col("rare"), "*").otherwise(F.col("seg"))
        rows = rows.join(rare, ["host", "node", "seg"], "left").withColumn("node", F.when(F.col("seg").isNotNull(), F.concat("node", F.lit("/"), name)).otherwise(F.col("node")))
        rows = rows.withColumn("at", F.when(F.col("seg").isNotNull(), F.concat("at", F.array("node"))).otherwise(F.col("at"))).drop("seg", "rare")
        rows = work.keep(rows, f"level{level}")
        work.drop(kids)
    return rows


def purities(paths: DataFrame, work: Work) -> DataFrame:
    """host, segs, node (the template), n, labelled, bad and purity of every generalised path."""
    rows = _grown(paths, work)
    both = paths.agg(F.sum("bad"), F.sum("labelled")).first()
    corpus = both[0] / both[1] if both[1] else 0.0
    level_of = rows.select("host", F.posexplode(F.concat(F.array(F.lit("")), "at")).alias("level", "node"), F.concat(F.array(F.lit("")), "at").alias("all"), "labelled", "bad")
    parent = F.when(F.col("level") > 0, F.element_at("all", F.greatest(F.col("level"), F.lit(1))))
    nodes = work.keep(level_of.groupBy("host", "level", "node", parent.alias("parent")).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "nodes")
    smooth = lambda bad, labelled, above: (bad + F.lit(WEIGHT) * above) / (labelled + F.lit(WEIGHT))
    known = nodes.where("level = 0").select("host", F.col("node").alias("parent"), F.col("labelled").alias("l0"), F.col("bad").alias("b0"), smooth(F.col("bad"), F.col("labelled"), F.lit(corpus)).alias("above"))
    every = known.select("host", F.col("parent").alias("node"), F.col("above").alias("purity"))
    for level in range(1, (nodes.agg(F.max("level")).first()[0] or 0) + 1):
        kids = nodes.where(F.col("level") == level).select("host", "node", "parent", "labelled", "bad").join(known, ["host", "parent"])
        rest_l, rest_b = F.col("l0") - F.col("labelled"), F.col("b0") - F.col("bad")
        # paths that end at the parent are among the siblings
        p, one = F.try_divide("b0", "l0"), F.lit(1.0)
        spread = F.sqrt(p * (1 - p) * (F.try_divide(one, "labelled") + F.try_divide(one, rest_l)))
        apart = (p > 0) & (p < 1) & (F.abs(F.try_divide("bad", "labelled") - F.try_divide(rest_b, rest_l)) >= F.lit(Z) * spread)  # null, so not apart, without labels on either side
        kids = work.keep(kids.withColumn("apart", F.coalesce(apart, F.lit(False))), f"kids{level}")
        pool = kids.where("NOT apart").groupBy("host", "parent").agg(F.sum("labelled").alias("pl"), F.sum("bad").alias("pb"))
        judged = kids.join(pool, ["host", "parent"], "left").withColumn("purity", smooth(F.when(F.col("apart"), F.col("bad")).otherwise(F.col("pb")), F.when(F.col("apart"), F.col("labelled")).otherwise(F.col("pl")), F.col("above")))
        known = work.keep(judged.select("host", F.col("node").alias("parent"), F.col("labelled").alias("l0"), F.col("bad").alias("b0"), F.col("purity").alias("above")), f"purity{level}")
        every = every.unionByName(known.select("host", F.col("parent").alias("node"), F.col("above").alias("purity")))
    return rows.join(every, ["host", "node"]).select("host", "segs", "node", "n", "labelled", "bad", "purity")


def _facts(pages: DataFrame, rules: Sequence[Rule], label: Column | None) -> DataFrame:
    """page_id, host, path, rule, ruling, and label: true for bad, false for good, else null."""
    host, path = parsed(F.col("url"))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), *([label.cast("boolean").alias("label")] if label is not None else []))
    p = p.withColumn("x", ruled(F.col("host"), F.col("path"), rules)).select("*", F.col("x.rule").alias("rule"), F.col("x.verdict").alias("ruling")).drop("x")
    return p if label is not None else p.withColumn("label", F.col("ruling") == "block")


def templates(pages: DataFrame, rules: Sequence[Rule], label: Column | None = None, work: Work | None = None) -> DataFrame:
    """host, segs (a generalised path), node (its template), n, labelled, bad, purity; rejected are those of REJECT or more."""
    work = work or Work(pages.sparkSession, "urls")
    paths = _facts(pages, rules, label).groupBy("host", shape(F.col("path")).alias("segs")).agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.count_if("label").alias("bad"))
    return purities(work.keep(paths, "paths"), work)


def judge(pages: DataFrame, rules: Sequence[Rule], label: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row; label: whether a row is known to be bad (true), good (false) or neither,
    by default what the rules say."""
    work = Work(pages.sparkSession, "urls")
    f = _facts(pages, rules, label)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    rejected = work.keep(templates(pages, rules, label, work).where(F.col("purity") >= REJECT - 1e-9).select("host", F.to_json("segs").alias("segs")).distinct(), "rejected").select("host", "segs", salts, F.lit("block").alias("found"))
    open_ = f.where("rule IS NULL").withColumns({"segs": F.to_json(shape(F.col("path"))), "salt": F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")})
    open_ = open_.join(rejected, ["host", "segs", "salt"], "left").select("page_id", "host", "path", "rule", F.coalesce("found", F.lit("allow")).alias("verdict"))
    return f.where("rule IS NOT NULL").select("page_id", "host", "path", "rule", F.col("ruling").alias("verdict")).unionByName(open_)

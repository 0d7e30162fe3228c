"""Annotator verdicts: validation, majority vote, audit decisions, wide records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import parse_bool

NEUTRAL_SPELLINGS = ("safe", "none", "no_violation", "clean")


@dataclass(frozen=True)
class Profile:
    """What differs between corpora: the neutral label, priorities, whether verdicts are validated, the audit's boundary."""

    priority: Mapping[str, int]
    neutral: str = "safe"
    validate: bool = True
    reject_boundary: bool = False
    jurors: Sequence[str] = field(default=("A", "B", "C"))


def valid_category(category: Column, profile: Profile) -> Column:
    """The category, the neutral one for its other spellings and for null, null for one outside the taxonomy."""
    t = F.trim(category)
    return F.when(category.isNull(), profile.neutral).when(t.isin(profile.neutral, *profile.priority), t).when(F.lower(t).isin(*NEUTRAL_SPELLINGS), profile.neutral)


def validated(verdicts: DataFrame, profile: Profile) -> DataFrame:
    """verdicts with violation (true, false or null), category and error put in order."""
    c = valid_category(F.col("category"), profile)
    v = F.col("violation")
    bad, neutral = c.isNull(), c == profile.neutral
    violation = F.when(bad, None).when(neutral, False).otherwise(v)
    kind = F.when(bad | neutral, profile.neutral).when(~v, profile.neutral).otherwise(c)
    error = F.when(bad, F.concat(F.lit("invalid category: "), F.col("category"))).when(~neutral & v.isNull(), "missing or invalid violation")
    return verdicts.withColumns({"violation": violation.cast("boolean"), "category": kind, "error": error})


def _priority(category: Column, profile: Profile) -> Column:
    m = F.create_map(*[F.lit(x) for kv in profile.priority.items() for x in kv]) if profile.priority else None
    return F.coalesce(m[category], F.lit(0)) if m is not None else F.lit(0)


def majority_vote(verdicts: DataFrame, profile: Profile, id_col: str = "content_id") -> DataFrame:
    """One row a content_id: final_violation, final_category, vote_method, requires_review, adopted_juror, the reported
    counts (with one null they say 2:1 or 1:2 all the same) and the true ones.

    verdicts: id, juror, violation, category, one row a juror."""
    v = validated(verdicts, profile) if profile.validate else verdicts
    # not the mode: the violating category of highest priority, the first juror's on ties
    order = F.lit(0) - F.array_position(F.array(*[F.lit(j) for j in profile.jurors]), F.col("juror"))
    ranked = F.struct(_priority(F.col("category"), profile).alias("p"), order.alias("o"))
    g = v.groupBy(id_col).agg(
        F.count_if(F.col("violation")).alias("y"),
        F.count_if(~F.col("violation")).alias("n"),
        F.count_if(F.col("violation").isNull()).alias("u"),
        F.max_by(F.when(F.col("violation"), F.col("category")), F.when(F.col("violation"), ranked)).alias("top"),
        F.concat_ws(" / ", F.transform(F.array_sort(F.collect_list(F.struct("juror", "violation"))), lambda x: F.concat(F.lit("Juror_"), x["juror"], F.lit(":"), F.when(x["violation"], "violation").when(~x["violation"], "clean").otherwise("null")))).alias("vote_agreement"),
    )
    y, n, u = F.col("y"), F.col("n"), F.col("u")
    method = F.when(u >= 2, "all_null").when((y == 3) | (n == 3), "unanimous").when((y == 2) | (n == 2), "majority").otherwise("split")
    yes, no = (u < 2) & (y >= 2), (u < 2) & (n >= 2)
    return g.select(
        id_col,
        F.when(yes, True).when(no, False).alias("final_violation"),
        F.when(yes, F.col("top")).otherwise(profile.neutral).alias("final_category"),
        method.alias("vote_method"),
        "vote_agreement",
        (~(yes | no)).alias("requires_review"),
        F.when(yes | no, F.when((y == 3) | (n == 3), "consensus").otherwise("majority")).otherwise("safe").alias("adopted_juror"),
        F.when((u < 2) & (y == 2), 2).when((u < 2) & (n == 2), 1).otherwise(y).cast("long").alias("violation_count"),
        F.when((u < 2) & (y == 2), 1).when((u < 2) & (n == 2), 2).otherwise(n).cast("long").alias("clean_count"),
        y.alias("true_violation_count"), n.alias("true_clean_count"), u.alias("true_null_count"),
    )


def wide(verdicts: DataFrame, columns: Sequence[str], jurors: Sequence[str] = ("A", "B", "C"), id_col: str = "content_id") -> DataFrame:
    """juror_a_<column> ... for every juror and column: one aggregation, no pivot's second pass."""
    return verdicts.groupBy(id_col).agg(*[F.max(F.when(F.col("juror") == j, F.col(c))).alias(f"juror_{j.lower()}_{c}") for j in jurors for c in columns])


def latency(verdicts: DataFrame, id_col: str = "content_id") -> DataFrame:
    return verdicts.groupBy(id_col).agg(F.sum("latency_ms").alias("total_latency_ms"), F.max("latency_ms").alias("max_latency_ms"), F.avg("latency_ms").alias("mean_latency_ms"))


def majority_item(df: DataFrame, col: str, id_col: str = "content_id") -> DataFrame:
    """The most frequent value that isn't blank, the smallest on ties, empty without one."""
    t = F.trim(F.coalesce(F.col(col), F.lit("")))
    n = df.groupBy(id_col, t.alias("v")).agg(F.count("*").alias("n"))
    key = F.when(F.col("v") != "", F.struct((-F.col("n")).alias("m"), "v"))
    return n.groupBy(id_col).agg(F.coalesce(F.min(key)["v"], F.lit("")).alias(col))


def majority_bool(df: DataFrame, col: str, id_col: str = "content_id") -> DataFrame:
    """The more frequent of true and false, by value or spelling; null on ties and without any."""
    b = parse_bool(col)
    return df.groupBy(id_col).agg(F.when(F.count_if(b) > F.count_if(~b), True).when(F.count_if(b) < F.count_if(~b), False).alias(col))


def audit_action(profile: Profile) -> Column:
    """struct(label_match, usable, risk, action, reason) from current_label, final_category, requires_review, usable,
    audit_action and risk_level of a voted row; the first case that holds decides."""
    match = F.col("final_category") == F.col("current_label")
    usable = F.coalesce("usable", F.lit(True))
    risk = F.nullif(F.col("risk_level"), F.lit(""))
    bound = ("reject", "high") if profile.reject_boundary else ("review", "medium")

    def out(m: Column, ok: Column, r: Column, action: str, reason: str) -> Column:
        return F.struct(m.alias("label_match"), ok.alias("usable"), r.alias("risk"), F.lit(action).alias("action"), F.lit(reason).alias("reason"))

    t, f, medium, high = F.lit(True), F.lit(False), F.lit("medium"), F.lit("high")
    return (
        F.when(F.col("requires_review"), out(match, usable, medium, "review", "jury_split_or_null"))
        .when(~match & usable, out(f, t, medium, "review", "category_mismatch_but_usable"))
        .when(~match, out(f, f, high, "reject", "category_mismatch_unusable"))
        .when(~usable | (F.col("audit_action") == "reject"), out(t, f, F.coalesce(risk, F.lit(bound[1])), bound[0], "juror_reject_despite_label_match"))
        .when((F.col("audit_action") == "review") | F.col("risk_level").isin("medium", "high"), out(t, usable, F.coalesce(risk, medium), "review", "juror_boundary_risk"))
        .otherwise(out(t, t, F.coalesce(risk, F.lit("low")), "accept", "label_match_low_risk"))
    )


def unanimity(wide_rows: DataFrame, jurors: Sequence[str] = ("A", "B", "C")) -> DataFrame:
    """Share of rows, among those with all verdicts, in which they agree."""
    cols = [F.col(f"juror_{j.lower()}_violation") for j in jurors]
    whole = wide_rows.dropna(subset=[f"juror_{j.lower()}_violation" for j in jurors])
    same = cols[0].isNotNull()
    for c in cols[1:]:
        same = same & (c == cols[0])
    return whole.agg(F.count("*").alias("complete"), F.round(F.avg(same.cast("double")), 6).alias("unanimity"))


def annotation_report(results: DataFrame, category: str = "final_category") -> DataFrame:
    """(section, item, n, pct): the distribution of categories and of violations (true, false, null), of vote methods,
    the mean of total_latency_ms, and how many complete juries agree, pct being of complete ones. One pass over results, columns
    juror_*_violation and total_latency_ms among them; sections whose columns are absent are left out."""
    cols = results.columns
    item = lambda section, name, n, weight: F.struct(F.lit(section).alias("section"), name.cast("string").alias("item"), n.cast("double").alias("x"), weight.cast("long").alias("w"))
    one = F.lit(1)
    items = [item("rows", F.lit("all"), one, one)]
    items += [item("category", F.col(category), one, one)] * (category in cols)
    items += [item("violation", F.coalesce(F.col("final_violation").cast("string"), F.lit("null")), one, one)] * ("final_violation" in cols)
    items += [item("vote_method", F.col("vote_method"), one, one)] * ("vote_method" in cols)
    items += [item("latency", F.lit("mean_total_ms"), F.col("total_latency_ms"), F.col("total_latency_ms").isNotNull())] * ("total_latency_ms" in cols)
    jury = [f"juror_{j}_violation" for j in "abc"]
    if set(jury) <= set(cols):
        a, b, c = (F.col(x) for x in jury)
        whole = a.isNotNull() & b.isNotNull() & c.isNotNull()
        items.append(item("agreement", F.lit("unanimous"), (whole & (a == b) & (b == c)).cast("int"), whole))
    g = results.select(F.explode(F.array(*items)).alias("i")).select("i.*").groupBy("section", "item").agg(F.sum("x").alias("x"), F.sum("w").alias("w"))
    total = g.agg(F.max(F.when(F.col("section") == "rows", F.col("w"))).alias("total"))  # one row
    mean = F.col("section") == "latency"
    n = F.when(mean, F.round(F.col("x") / F.col("w"), 4)).otherwise(F.coalesce("x", F.lit(0.0)))
    of = F.when(F.col("section") == "agreement", F.col("w")).otherwise(F.col("total"))
    return g.crossJoin(F.broadcast(total)).select("section", "item", n.alias("n"), F.when(~mean & (of > 0), F.round(n / of * 100, 1)).alias("pct"))

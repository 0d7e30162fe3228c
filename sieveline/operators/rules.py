"""Ordered row rules: the first that holds decides. Patterns, labels and actions come from the caller."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ..functions.text import cjk_heavy, contains_any, has_artifact, hashtag_only, normalise, symbol_only, url_only


@dataclass(frozen=True)
class Rule:
    """label and every pattern of `all_of` must fit, none of `none_of`; `exempt` is taken out of the text first. action is
    keep, drop or relabel (to new_label)."""

    label: str | None
    action: str
    reason: str
    new_label: str | None = None
    all_of: Sequence[str] = ()
    none_of: Sequence[str] = ()
    exempt: str | None = None

    def fits(self, label: Column, text: Column) -> Column:
        t = F.regexp_replace(text, "(?iuU)" + self.exempt, " ") if self.exempt else text
        out = F.lit(True) if self.label is None else label == self.label
        for p in self.all_of:
            out = out & t.rlike("(?iuU)" + p)
        for p in self.none_of:
            out = out & ~t.rlike("(?iuU)" + p)
        return out


def boundary_rules(drop_if_absent: Sequence[Rule] = (), drop_if_present: Sequence[Rule] = (), base: Sequence[Rule] = ()) -> list[Rule]:
    """A rule table with optional drops: for a label, its base rules come first, then the drops asked for, then its keep."""
    drops = {r.label: r for r in (*drop_if_absent, *drop_if_present)}
    out: list[Rule] = []
    for r in base:
        if r.action == "keep" and r.label in drops:
            out.append(drops[r.label])
        out.append(r)
    return out


def decide(label: Column, text: Column, rules: Sequence[Rule], only: Column | None = None, otherwise: str = "not_target_keep", outside: str = "real_or_original_keep") -> Column:
    """struct(action, reason, new_label)."""

    def out(action: str, reason: str, new: str | None) -> Column:
        return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"), F.lit(new).cast("string").alias("new_label"))

    lab, t = F.trim(F.coalesce(label, F.lit(""))), F.coalesce(text, F.lit(""))
    whens = [(r.fits(lab, t), out(r.action, r.reason, r.new_label)) for r in rules]
    if only is not None:
        whens.insert(0, (~F.coalesce(only, F.lit(False)), out("keep", outside, None)))
    last = out("keep", otherwise, None)
    if not whens:
        return last
    c = F.when(*whens[0])
    for w in whens[1:]:
        c = c.when(*w)
    return c.otherwise(last)


def apply_rules(df: DataFrame, decision: Column, label: str = "final_category", neutral: str = "safe") -> tuple[DataFrame, DataFrame]:
    """(clean, actions): rows that aren't dropped with their new label and final_violation moved along, and the audit trail
    of all rows, whose new label is empty where the row went."""
    (v,) = unused(df, "verdict")
    d = df.withColumn(v, decision)
    action = F.col(f"{v}.action")
    new = F.when(action == "relabel", F.col(f"{v}.new_label")).otherwise(F.col(label))
    clean = d.where(action != "drop").withColumn(label, new)
    clean = clean.withColumn("final_violation", F.col(label) != neutral).drop(v)
    actions = d.select("_ord", action.alias("action"), F.col(f"{v}.reason").alias("reason"), F.col(label).alias("old_label"), F.when(action == "drop", "").otherwise(new).alias("new_label"))
    return clean, actions


def rejection(text: Column, label: Column, wanted: Column, low: int, high: int, refusals: Sequence[str] = (), foreign: Column | None = None, artifacts: bool = False) -> Column:
    """The first reason against a generated text, null for none; the length's reason carries the length."""
    t = normalise(text)
    n = F.length(t)
    tests = [
        (t == "", F.lit("empty_clean_text")),
        (F.trim(F.coalesce(label, F.lit(""))) != wanted, F.lit("wrong_final_category")),
        ((n < low) | (n > high), F.concat(F.lit("bad_length_"), n.cast("string"))),
        (cjk_heavy(t), F.lit("chinese_detected")),
    ]
    if foreign is not None:
        tests.append((foreign, F.lit("obviously_foreign_response")))
    if refusals:
        tests.append((contains_any(t, refusals), F.lit("refusal_text")))
    if artifacts:
        tests.append((has_artifact(t), F.lit("operational_artifact")))
    return F.coalesce(*[F.when(c, r) for c, r in tests])


def invalid_text(text: Column, meta: Sequence[str], low: int = 8, high: int = 800) -> Column:
    """empty, invalid or null (fine)."""
    t = normalise(text)
    bad = ~F.length(t).between(low, high) | url_only(t) | hashtag_only(t) | symbol_only(t) | contains_any(t, meta)
    return F.when(t == "", "empty").when(bad, "invalid")

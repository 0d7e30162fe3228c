"""Corpus quality metrics, by our own definitions: shares of templates, hashtags, scenario hits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import halves
from ..functions.text import lower_key, normalise

HASHTAG = r"#[\p{L}\p{N}_]+"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"


def tokens(text: Column) -> Column:
    """Lower-cased words; an empty text has none."""
    t = lower_key(text)
    return F.when(t != "", F.split(t, " ")).otherwise(F.array().cast("array<string>"))


def hit_rates(df: DataFrame, label: str, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """(label, scenario, count, total, rate): a text may hit several scenarios. All patterns are counted in one pass."""
    t = F.coalesce(F.col(text), F.lit(""))
    g = df.groupBy(label).agg(F.count("*").alias("total"), *[F.count_if(t.rlike("(?iuU)" + p)).alias(s) for s, p in patterns.items()])
    long = g.unpivot([label, "total"], list(patterns), "scenario", "count")
    return long.select(label, "scenario", "count", "total", F.round(F.col("count") / F.col("total"), 4).alias("rate"))


def text_metrics(df: DataFrame, label: str, text: str, terms: Sequence[str] = ()) -> DataFrame:
    """mean_chars, hashtag_per_text, emoji_rate, term_rate by label."""
    t = F.coalesce(F.col(text), F.lit(""))
    term = F.lit(False)
    for x in terms:
        term = term | F.lower(t).contains(x)
    return df.groupBy(label).agg(
        F.count("*").alias("n"), F.round(F.avg(F.length(t)), 4).alias("mean_chars"), F.round(F.avg(F.regexp_count(t, F.lit(HASHTAG)).cast("double")), 4).alias("hashtag_per_text"),
        F.round(F.avg(t.rlike(EMOJI).cast("double")), 4).alias("emoji_rate"), F.round(F.avg(term.cast("double")), 4).alias("term_rate"),
    )


def unique_ratio(df: DataFrame, label: str, text: str) -> DataFrame:
    """Distinct tokens over tokens. Counted by (label, token) first, so a frequent token is combined before the shuffle."""
    w = df.select(label, F.explode(tokens(F.col(text))).alias("w")).groupBy(label, "w").agg(F.count("*").alias("n"))
    return w.groupBy(label).agg(F.round(F.count("*") / F.sum("n"), 4).alias("token_unique_ratio"))


def _top_share(items: DataFrame, label: str, item: str, top: int) -> DataFrame:
    """Share of the `top` most frequent items among all items of a label. Items are counted once; what the windows then
    sort is how many items have a count, a few rows a label."""
    counts = items.groupBy(label, item).agg(F.count("*").alias("n")).groupBy(label, "n").agg(F.count("*").alias("m"))
    before = W.partitionBy(label).orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)
    take = F.greatest(F.least(F.col("m"), F.lit(top) - F.coalesce(F.sum("m").over(before), F.lit(0))), F.lit(0))
    best = counts.select(label, (F.col("n") * F.col("m")).alias("every"), (F.col("n") * take).alias("best"))
    return best.groupBy(label).agg(F.round(F.sum("best") / F.sum("every"), 4).alias("share"))


def ngram_top_share(df: DataFrame, label: str, text: str, n: int, top: int = 10) -> DataFrame:
    """Share of the `top` most frequent n-grams among all n-grams of a label. Words and n-grams are 64-bit hashes."""
    t = df.select(label, F.transform(tokens(F.col(text)), lambda w: F.xxhash64(w)).alias("t")).where(F.size("t") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("t") - n + 1), lambda i: F.xxhash64(*[F.element_at("t", i + k) for k in range(n)]))
    return _top_share(t.select(label, F.explode(grams).alias("g")), label, "g", top)


def start_top_share(df: DataFrame, label: str, text: str, words: int = 4, top: int = 10) -> DataFrame:
    """Share of texts that begin with one of the `top` most frequent openings."""
    return _top_share(df.select(label, F.xxhash64(F.slice(tokens(F.col(text)), 1, words)).alias("s")), label, "s", top)


def top_hashtags(df: DataFrame, label: str, text: str, top: int = 30) -> DataFrame:
    t = df.select(label, F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(HASHTAG), 0)).alias("hashtag"))
    c = t.groupBy(label, "hashtag").agg(F.count("*").alias("n"))
    return c.withColumn("rn", F.row_number().over(W.partitionBy(label).orderBy(F.desc("n"), "hashtag"))).where(F.col("rn") <= top)


def review_sample(df: DataFrame, label: str, per_label: int, id_col: str, seed: int = 42) -> DataFrame:
    """per_label rows of each label in a seeded hash order."""
    lot = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    rn = F.row_number().over(W.partitionBy(label).orderBy(lot, id_col))
    return df.withColumn("rn", rn).where(F.col("rn") <= per_label)


def distinct_keys(df: DataFrame, label: str, text: str) -> DataFrame:
    """Distinct keys of a label, blank ones apart."""
    a, b = halves(lower_key(F.col(text)))
    return df.where(normalise(F.col(text)) != "").select(label, a.alias("h1"), b.alias("h2")).distinct().groupBy(label).agg(F.count("*").alias("unique_texts"))

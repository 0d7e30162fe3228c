"""Order-aware deduplication and exclusion by key.

First and last are decided by an explicit order column. Texts are never keys of a shuffle or a sort: keys are 128-bit
hashes, counted and compared by hash aggregates with map-side combining, so that a key that holds a third of all rows
never meets in one task as rows, and each row moves once, to meet its key's verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import halves, row_lot, unused
from ..functions.text import Key, lower_key
from ..sources.tables import settled


def _pick(df: DataFrame, key: Column, order: str, last: bool) -> DataFrame:
    h1, h2, h3, lot = unused(df, "h1", "h2", "h3", "lot")
    a, b = halves(key)
    d = df.withColumns({h1: a, h2: b, h3: F.xxhash64(order)})
    best = d.groupBy(h1, h2).agg((F.max if last else F.min)(order).alias(order)).select(h1, h2, F.xxhash64(order).alias(h3))
    # dealt by key and order, so that the rows of a hot key spread; ties are decided where the join has left them
    rows = d.join(best, [h1, h2, h3]).withColumn(lot, row_lot(df))
    return rows.groupBy(h1, h2, h3).agg(*[F.min_by(f"`{c}`", lot).alias(c) for c in df.columns]).drop(h1, h2, h3)


def keep_first(df: DataFrame, key: Column, order: str = "_ord") -> DataFrame:
    """One row a key, that of the least order. A null order comes after all others; of rows that tie, one is chosen by a hash
    of the row; a null key is a key like any other."""
    return _pick(df, key, order, last=False)


def keep_last(df: DataFrame, key: Column, order: str = "_ord") -> DataFrame:
    """One row a key, that of the greatest order; nulls and ties as in keep_first."""
    return _pick(df, key, order, last=True)


def duplicate_count(df: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of their key."""
    a, b = halves(key)
    per_key = df.groupBy(a.alias("h1"), b.alias("h2")).agg(F.count("*").alias("n"))
    return per_key.agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("duplicates"))


def key_hashes(df: DataFrame, key: Column, h1: str = "h1", h2: str = "h2") -> DataFrame:
    """The distinct keys of df that aren't blank, as two longs."""
    a, b = halves(key)
    return df.where(key != "").select(a.alias(h1), b.alias(h2)).distinct()


def exclude(df: DataFrame, seen: DataFrame | None, text: str, seen_text: str | None = None, key: Key = lower_key) -> DataFrame:
    """Rows whose key is not in seen. A blank key never counts as seen; no seen table excludes nothing."""
    if seen is None:
        return df
    h1, h2 = unused(df, "h1", "h2")
    a, b = halves(key(F.col(text)))
    return df.withColumns({h1: a, h2: b}).join(key_hashes(seen, key(F.col(seen_text or text)), h1, h2), [h1, h2], "left_anti").drop(h1, h2)


def exclude_ids(df: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """Resume: rows whose id, as text, isn't done."""
    (name,) = unused(df, "id_text")
    ids = done.select(F.col(id_col).cast("string").alias(name)).where(F.col(name).isNotNull())
    return df.withColumn(name, F.col(id_col).cast("string")).join(ids, name, "left_anti").drop(name)


def classify_duplicates(df: DataFrame, original: DataFrame, synthetic: DataFrame, key: str = "key", order: str = "_ord") -> DataFrame:
    """df with reason: in_batch (not the first of its key), else original, else synthetic, else accepted. Every row stays; a
    null key is a key like any other.

    What is known of a key (its first row, whether it is original or synthetic) is one aggregate over narrow rows of all
    three tables."""
    h1, h2, first, o, s = unused(df, "h1", "h2", "first", "o", "s")
    a, b = halves(F.col(key))
    none = F.lit(None)
    kind = df.schema[order].dataType

    def narrow(t: DataFrame, at: Column, is_o: bool, is_s: bool) -> DataFrame:
        return t.select(a.alias(h1), b.alias(h2), at.cast(kind).alias(first), F.lit(is_o).alias(o), F.lit(is_s).alias(s))

    every = narrow(df, F.col(order), False, False).union(narrow(original, none, True, False)).union(narrow(synthetic, none, False, True))
    marks = every.groupBy(h1, h2).agg(F.min(first).alias(first), F.max(o).alias(o), F.max(s).alias(s))
    reason = F.when(F.col(order) > F.col(first), "in_batch").when(F.col(o), "original").when(F.col(s), "synthetic").otherwise("accepted")
    return df.withColumns({h1: a, h2: b}).join(marks, [h1, h2], "left").withColumn("reason", reason).drop(h1, h2, first, o, s)


def rank_first(df: DataFrame, by: str, order: str, most: int, rank: str = "rn") -> DataFrame:
    """The `most` first rows of each group with their rank. First the groups are ranked in pieces, dealt by a hash of the
    order, and then among what the pieces leave; so a group with a third of all rows is never gathered in one task, and no
    setting of the session decides it. Equal orders tie in no fixed way."""
    (piece,) = unused(df, "piece")
    pieces = min(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    d = df.withColumn(piece, F.pmod(F.xxhash64(order), F.lit(pieces)))
    d = d.withColumn(rank, F.row_number().over(W.partitionBy(by, piece).orderBy(order))).where(F.col(rank) <= most).drop(rank)
    return d.drop(piece).withColumn(rank, F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col(rank) <= most)


def cap_per_flag(df: DataFrame, flags: Sequence[str], cap: int, order: str = "_ord") -> DataFrame:
    """Rows among the first `cap` of any of their flags; a row may qualify by several. order has no repeats."""
    long = df.select(order, F.explode(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags])).alias("flag")).where("flag IS NOT NULL")
    picked = rank_first(long, "flag", order, cap).select(order).distinct()
    return df.join(picked, order, "left_semi")


def failed_run(df: DataFrame, bad: Column, run: int, order: str) -> DataFrame:
    """start_at and stop_at: the orders of the first and the last of the first `run` bad rows in succession, null for none.

    Rows are dealt by ranges of the order. Each range is numbered by itself; numbers become global by the counts of the
    ranges before, a row a range. A run is then a group of equal difference between a bad row's number among all and its
    number among the bad ones, and is counted with map-side combining."""
    narrow = df.select(F.col(order).alias("ord"), F.coalesce(bad, F.lit(False)).alias("bad")).repartitionByRange("ord")
    d = settled(narrow.withColumn("range", F.spark_partition_id()), "runs")
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    per = d.groupBy("range").agg(F.count("*").alias("n"), F.count_if("bad").alias("b"))
    per = per.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"))
    own = W.partitionBy("range").orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = d.withColumns({"n": F.row_number().over(W.partitionBy("range").orderBy("ord")), "b": F.sum(F.col("bad").cast("long")).over(own)}).where("bad")
    at = counted.join(F.broadcast(per), "range").select("ord", (F.col("n") + F.col("n0")).alias("n"), (F.col("b") + F.col("b0")).alias("b"))
    runs = at.groupBy((F.col("n") - F.col("b")).alias("island")).agg(F.count("*").alias("size"), F.min("n").alias("first")).where(F.col("size") >= run)
    ends = runs.agg(F.min("first").alias("first")).select(F.explode(F.array("first", F.col("first") + run - 1)).alias("n"))  # two rows
    return at.join(F.broadcast(ends.distinct()), "n").agg(F.min("ord").alias("start_at"), F.max("ord").alias("stop_at"))


def first_failures(df: DataFrame, bad: Column, run: int, order: str = "_ord") -> DataFrame:
    """stop_at: the order of the row at which `run` bad rows in succession are complete; null where there is no such run."""
    return failed_run(df, bad, run, order).select("stop_at")


def until_failures(df: DataFrame, bad: Column, run: int, order: str = "_ord") -> DataFrame:
    """A circuit breaker: the rows before the first `run` bad ones in succession, which go with all that comes after; all
    rows where there is no such run. The place is found first, so that the filter on the order reaches the scan."""
    start = failed_run(df, bad, run, order).first()["start_at"]  # one row
    return df if start is None else df.where(F.col(order) < F.lit(start))

"""Class balance and quota selection: folds over a few sources or labels, each stage seeing what earlier ones took."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import halves, row_lot, unused
from ..functions.text import Key, md5_key, strip_key
from ..sources.tables import settled
from .dedup import key_hashes, keep_first, rank_first
from .keystore import keyed


#: Quantiles a label of the histogram that cut-offs are found in, and its accuracy.
GRID, ACCURACY = 512, 20_000


def cutoffs(rows: DataFrame, need: Mapping[str, int], label: str, order: str) -> DataFrame:
    """(label, cut, spare) for each label with more than `need` rows: those before `cut` and `spare` of those at it are its first.

    Two passes over two columns. The first counts and makes a histogram of the order by label, with map-side combining and of
    a fixed size; it tells two bounds that the cut-off lies between. The second counts what lies below them and ranks only
    what lies between, some 4 / GRID of a label. The histogram decides how much that is, not the result."""
    spark = rows.sparkSession
    narrow = rows.select(F.col(label).alias("l"), F.col(order).alias("o")).where(F.col("l").isin(*need))
    grid = [k / GRID for k in range(GRID + 1)]
    bounds = []
    for r in narrow.groupBy("l").agg(F.count("*").alias("n"), F.percentile_approx("o", grid, ACCURACY).alias("q")).collect():  # a row a label
        if r["n"] > need[r["l"]] > 0:
            k = need[r["l"]] * GRID // r["n"]
            bounds.append((r["l"], r["q"][k - 2] if k >= 2 else None, r["q"][k + 2] if k + 2 <= GRID else None, need[r["l"]]))
    kind = rows.schema[order].dataType.simpleString()
    if not bounds:
        return spark.createDataFrame([], f"l string, cut {kind}, spare long").withColumnRenamed("l", label)
    b = spark.createDataFrame(bounds, f"l string, lo {kind}, hi {kind}, need long")
    met = narrow.join(F.broadcast(b), "l").where(F.col("hi").isNull() | (F.col("o") <= F.col("hi")))
    # what is below is one row a label, what is between a row for each order
    at = F.when(F.col("lo").isNotNull() & (F.col("o") < F.col("lo")), F.lit(None)).otherwise(F.col("o"))
    per = met.groupBy("l", "need", at.alias("o")).agg(F.count("*").alias("n"))
    ranked = per.withColumn("before", F.sum("n").over(W.partitionBy("l").orderBy(F.col("o").asc_nulls_first())) - F.col("n"))
    found = ranked.where((F.col("before") < F.col("need")) & (F.col("before") + F.col("n") >= F.col("need")))
    return found.select(F.col("l").alias(label), F.col("o").alias("cut"), (F.col("need") - F.col("before")).alias("spare"))


def first_of_label(df: DataFrame, need: DataFrame, label: str, most: int, order: str = "_ord") -> DataFrame:
    """The first `need` rows of each label; `most` bounds all needs. need has one row a label, and labels are a list the
    caller gives. Of rows that tie at a cut-off some are taken, by a hash of the row; null orders come first.

    An order of numbers or times without nulls is cut by `cutoffs`, and rows are filtered once where they are; df should be
    a written table, as it is passed three times, twice for two columns only. Other orders are ranked in pieces."""
    wanted = {r[0]: min(most, r[1]) for r in need.select(label, "need").collect()}  # a row a label
    kind = df.schema[order].dataType
    if not isinstance(kind, T.NumericType | T.TimestampType | T.DateType) or isinstance(kind, T.DecimalType) or not df.where(F.col(order).isNull() & F.col(label).isin(*wanted)).isEmpty():
        n, rn = unused(df, "need", "rn")
        ranked = rank_first(df, label, order, most, rn)
        return ranked.join(F.broadcast(need.withColumnRenamed("need", n)), label).where(F.col(rn) <= F.col(n)).drop(rn, n)
    found = {r[label]: (r["cut"], r["spare"]) for r in cutoffs(df, wanted, label, order).collect()}
    if lost := [x for x, (cut, _) in found.items() if cut is None]:
        raise ArithmeticError(f"a histogram missed its accuracy for {lost}")
    cut, spare, rn = unused(df, "cut", "spare", "rn")
    cfg = df.sparkSession.createDataFrame([(x, *found.get(x, (None, None))) for x, n in wanted.items() if n > 0], f"{label} string, {cut} {kind.simpleString()}, {spare} long")
    rows = df.join(F.broadcast(cfg), label)
    first = rows.where(F.col(cut).isNull() | (F.col(order) < F.col(cut))).drop(cut, spare)
    # at a cut-off that several rows share, so many as are missing
    ties = rows.where(F.col(order) == F.col(cut)).withColumn(cut, row_lot(df))
    ties = rank_first(ties, label, cut, most, rn).where(F.col(rn) <= F.col(spare)).drop(cut, spare, rn)
    return first.select(*df.columns).unionByName(ties.select(*df.columns))


def balance(main: DataFrame, sources: Sequence[tuple[str, DataFrame]], labels: Sequence[str], target: int, text: str = "clean_text", label: str = "final_category", key: Key = strip_key) -> DataFrame:
    """Rows taken from the sources, in their order, until each label of main has `target` rows.

    A source gives each key once, by its first row among those not taken yet; a key left because its label was full may
    still come under another label from a later source. Adds balance_source; main itself is neither filtered nor changed."""
    spark = main.sparkSession
    cfg = spark.createDataFrame([(x,) for x in labels], f"{label} string")
    k = key(F.col(text))
    seen = key_hashes(main, k)
    have = main.groupBy(label).agg(F.count("*").alias("n"))
    taken = None
    for name, df in sources:
        need = cfg.join(have, label, "left").select(label, F.greatest(F.lit(target) - F.coalesce("n", F.lit(0)), F.lit(0)).alias("need")).where("need > 0")
        h1, h2 = unused(df, "h1", "h2")
        a, b = halves(k)
        fresh = df.where(F.col(label).isin(*labels) & (k != "")).withColumns({h1: a, h2: b})
        fresh = fresh.join(seen.toDF(h1, h2), [h1, h2], "left_anti").drop(h1, h2)
        once = settled(keep_first(fresh, k), "once")
        picked = settled(first_of_label(once, need, label, target).withColumn("balance_source", F.lit(name)), "balance")
        taken = picked if taken is None else taken.unionByName(picked, allowMissingColumns=True)
        seen = seen.union(key_hashes(picked, k))
        have = have.unionByName(picked.groupBy(label).agg(F.count("*").alias("n"))).groupBy(label).agg(F.sum("n").alias("n"))
    return taken if taken is not None else main.limit(0)


def quota_select(pool: DataFrame, plan: Sequence[tuple[str, Sequence[str], int, float]], text: str, flags: Sequence[str], seed: int = 42, key: Key = md5_key) -> DataFrame:
    """Rows for each (label, flags_any, need, ratio) in turn: those with any of the flags whose key no earlier label took;
    duplicates within a label stay. A ratio of 999 or more takes all; else int(need * ratio) by a seeded hash order."""
    p, h1, h2 = keyed(pool, key(F.col(text)))
    used = taken = None
    for label, any_of, need, ratio in plan:
        c = p.where(F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in any_of], F.lit(0)) == 1)
        if used is not None:
            c = c.join(used, [h1, h2], "left_anti")
        if ratio < 999:
            c = sample_up_to(c, int(need * ratio), key(F.col(text)), seed)
        c = settled(c.withColumn("target_label", F.lit(label)), "quota")
        taken = c if taken is None else taken.unionByName(c)
        used = taken.select(h1, h2).distinct()
    return taken.drop(h1, h2)


def sample_up_to(df: DataFrame, n: int, key: Column, seed: int = 42, order: str = "_ord") -> DataFrame:
    """n rows without replacement in the order of md5(key, seed); all where there are fewer. The same on every engine.

    By threshold (`first_by`), so that no task gathers the n rows."""
    (lot,) = unused(df, "lot")
    return first_by(df.withColumn(lot, F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))), n, lot, order).drop(lot)


def first_by(df: DataFrame, n: int, lot: str, order: str) -> DataFrame:
    """The first n rows by (lot, order), lot being a text of hexadecimal digits that are spread evenly.

    Rows are counted by the lot's first digits (4,096 groups, with map-side combining). The group that the n-th row falls into
    is the boundary: groups before it are taken whole by a filter, of it the rows that are missing are taken in order. Equal
    (lot, order) are told apart in no fixed way."""
    if n <= 0:
        return df.limit(0)
    counts = sorted((r[0] or "", r[1]) for r in df.groupBy(F.substring(lot, 1, 3)).agg(F.count("*")).collect())  # 4,097 rows at most
    before = 0
    for digits, m in counts:
        if before + m > n:
            head = F.coalesce(F.substring(lot, 1, 3), F.lit(""))
            rest = df.where(head == digits).orderBy(lot, order).limit(n - before)
            return df.where(head < digits).unionByName(rest)
        before += m
    return df


def split_main_overflow(rows: DataFrame, need: Mapping[str, int], label: str, key: str, order: str = "_ord") -> DataFrame:
    """rows (older overflow first in order) with part main or overflow: the first `need` distinct keys of a label are main.
    order has no repeats; rows of labels outside need go."""
    part, n, rn = unused(rows, "part", "need", "rn")
    once = keep_first(rows.where(F.col(label).isin(*need)), F.concat_ws("\x1f", label, key), order)
    cfg = rows.sparkSession.createDataFrame([*need.items()], f"{label} string, {n} int")
    ranked = rank_first(once.select(label, order), label, order, max([0, *need.values()]), rn).join(F.broadcast(cfg), label)
    main = ranked.where(F.col(rn) <= F.col(n)).select(label, order, F.lit(True).alias(rn))
    return once.join(main, [label, order], "left").withColumn(part, F.when(F.col(rn), "main").otherwise("overflow")).drop(rn)


def promote(main: DataFrame, overflow: DataFrame, need: Mapping[str, int], label: str, text: str, order: str = "_ord", key: Key = strip_key) -> tuple[DataFrame, DataFrame]:
    """(main, overflow) after the first `need` distinct keys of each label have moved from overflow to main, in order.

    A key stands under the label of its first row; all rows of overflow with a promoted key go. order has no repeats in
    overflow; main gets the columns it has."""
    k = key(F.col(text))
    n, rn = unused(overflow, "need", "rn")
    once = keep_first(overflow, k, order)
    cfg = overflow.sparkSession.createDataFrame([*need.items()], f"{label} string, {n} int")
    ranked = rank_first(once.where(F.col(label).isin(*need)).select(label, order), label, order, max([0, *need.values()]), rn).join(F.broadcast(cfg), label)
    moved = settled(once.join(ranked.where(F.col(rn) <= F.col(n)).select(order), order, "left_semi"), "promoted")
    columns = [c for c in main.columns if c in moved.columns]
    h1, h2 = unused(overflow, "h1", "h2")
    a, b = halves(k)
    gone = moved.select(a.alias(h1), b.alias(h2))
    rest = overflow.withColumns({h1: a, h2: b}).join(gone, [h1, h2], "left_anti").drop(h1, h2)
    return main.unionByName(moved.select(*columns), allowMissingColumns=True), rest


def violations(rows: DataFrame, original: DataFrame, labels: Sequence[str], label: str, text: str, key: Key) -> DataFrame:
    """Counts of broken output invariants in one row: empty, label out of scope, repeated key, key of the original. One
    aggregate by key over narrow rows of both tables, then one of counts."""
    k = key(F.col(text))
    a, b = halves(k)
    bad = ~F.coalesce(F.col(label).isin(*labels), F.lit(False))
    r = rows.select(a.alias("h1"), b.alias("h2"), F.lit(1).alias("n"), (k == "").cast("long").alias("empty"), bad.cast("long").alias("bad"), F.lit(False).alias("o"))
    o = original.select(a.alias("h1"), b.alias("h2"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("empty"), F.lit(0).cast("long").alias("bad"), F.lit(True).alias("o"))
    c = r.union(o).groupBy("h1", "h2").agg(*[F.sum(x).alias(x) for x in ("n", "empty", "bad")], F.max("o").alias("o"))
    zero = lambda x: F.coalesce(x, F.lit(0))
    return c.agg(
        zero(F.sum("empty")).alias("empty_text"), zero(F.sum("bad")).alias("bad_label"), (zero(F.sum("n")) - F.count_if(F.col("n") > 0)).alias("repeated_key"), zero(F.sum(F.when(F.col("o"), F.col("n")))).alias("in_original"),
    )

"""Keyed merge of two label schemas, and the summaries of the merged corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.flags import any_flag
from ..functions.text import Key, md5_key, normalise, py_strip
from ..sources import tables as io

_CORPUS = re.compile(r"corpus-(\d{10})-(\d+)$")


def key_states(train: DataFrame | None, new: DataFrame | None, flags: Sequence[str], group: Sequence[str] = (), key: Key = md5_key) -> DataFrame:
    """What a corpus must know of each key: h1, h2, the groups, key, text, label_name, source, t_ord (the order of the train row
    that counts, null without one), from_train, n_new, n_ord (the least order in new) and the largest of each flag. One row a key.

    Keys are two longs. Counts, orders and flags are one hash aggregate over narrow rows of both tables; whole rows move once,
    to meet the verdict of their key, and only the winner's text is kept. A null group is a group of its own."""
    g = [f"`{c}`" for c in group]
    parts = []
    for df, is_new in ((train, False), (new, True)):
        if df is None:
            continue
        k = key(F.col("text"))
        at = [F.col(c).isNull() for c in g] + [F.col(c) for c in g]  # (null, x) and (x, null) are two groups
        h1, h2 = F.xxhash64(*at, k), F.xxhash64(F.lit("second half"), *at, k)
        empty = F.lit("")
        label, source = (F.lit(None).cast("string"),) * 2 if is_new else (F.coalesce("label_name", empty), F.coalesce("source", empty))
        own = [(F.col(f"`{f}`") if is_new else F.lit(None).cast("int")).alias(f) for f in flags]
        parts.append(df.select(h1.alias("h1"), h2.alias("h2"), F.lit(is_new).alias("is_new"), F.col("_ord").alias("ord"), *g, "text", label.alias("label_name"), source.alias("source"), *own))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    n, t = F.count_if("is_new"), F.count_if(~F.col("is_new"))
    sums = every.groupBy("h1", "h2").agg(
        (t > 0).alias("from_train"), n.alias("n_new"), F.max(F.when(~F.col("is_new"), F.col("ord"))).alias("t_ord"), F.min(F.when(F.col("is_new"), F.col("ord"))).alias("n_ord"), *[F.max(f"`{f}`").alias(f) for f in flags]
    )
    at = F.when(F.col("from_train"), F.col("t_ord")).otherwise(F.col("n_ord"))
    sums = sums.withColumn("h3", F.xxhash64(~F.col("from_train"), at))
    rows = every.select("h1", "h2", F.xxhash64("is_new", "ord").alias("h3"), *g, "text", "label_name", "source")
    rows = rows.withColumn("lot", F.xxhash64("text", "label_name", "source"))  # rows that tie in their order
    won = rows.join(sums, ["h1", "h2", "h3"]).groupBy("h1", "h2", "h3").agg(
        F.max_by(F.struct(*g, "text", "label_name", "source"), "lot").alias("row"), *[F.first(c).alias(c) for c in ("from_train", "n_new", "t_ord", "n_ord")], *[F.first(f"`{f}`").alias(f) for f in flags]
    )
    text = F.col("row.text")
    return won.select(
        "h1", "h2", *[F.col(f"row.{c}").alias(c.strip("`")) for c in g], key(text).alias("key"), normalise(text).alias("text"), py_strip("row.label_name").alias("label_name"), py_strip("row.source").alias("source"),
        "from_train", "t_ord", "n_new", "n_ord", *[f"`{f}`" for f in flags],
    )


def absorbed(states: DataFrame, batch: DataFrame, flags: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """States of two parts of a corpus as states of the whole; the order of the parts decides only between equal orders, where
    the batch wins. One join by key, for which a side that is bucketed by h1, h2 doesn't move."""
    a, b = states.alias("a"), batch.alias("b")

    def of(side: str, c: str) -> Column:
        return F.col(f"{side}.`{c}`")

    # the text that counts: of the later train row, else of the earlier new one
    later = of("a", "t_ord").isNull() | (of("b", "t_ord") >= of("a", "t_ord"))
    by_train = of("b", "from_train") & (~of("a", "from_train") | F.coalesce(later, F.lit(False)))
    by_new = ~of("a", "from_train") & ~of("b", "from_train") & F.coalesce(of("b", "n_ord") < of("a", "n_ord"), F.lit(False))
    taken = of("a", "h1").isNull() | F.coalesce(by_train | by_new, F.lit(False))

    def pick(c: str) -> Column:
        return F.when(taken, of("b", c)).otherwise(of("a", c)).alias(c)

    zero = F.lit(0).cast("long")
    return a.join(b, (of("a", "h1") == of("b", "h1")) & (of("a", "h2") == of("b", "h2")), "full_outer").select(
        F.coalesce(of("a", "h1"), of("b", "h1")).alias("h1"), F.coalesce(of("a", "h2"), of("b", "h2")).alias("h2"), *[pick(c) for c in (*group, "key", "text", "label_name", "source")],
        (F.coalesce(of("a", "from_train"), F.lit(False)) | F.coalesce(of("b", "from_train"), F.lit(False))).alias("from_train"),
        F.greatest(of("a", "t_ord"), of("b", "t_ord")).alias("t_ord"), (F.coalesce(of("a", "n_new"), zero) + F.coalesce(of("b", "n_new"), zero)).alias("n_new"),
        F.least(of("a", "n_ord"), of("b", "n_ord")).alias("n_ord"), *[F.greatest(of("a", f), of("b", f)).alias(f) for f in flags],
    )


def merged_view(states: DataFrame, flags: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """The merged corpus as merge_schemas gives it."""
    origin = F.when(F.col("n_new") == 0, "train_only").when(F.col("from_train") | (F.col("n_new") >= 2), "both").otherwise("new_only")
    empty = F.lit("")
    return states.select(
        *[f"`{c}`" for c in group], "key", "text", F.coalesce("label_name", empty).alias("label_name"), *[F.coalesce(F.col(f"`{f}`"), F.lit(0)).alias(f) for f in flags], F.coalesce("source", empty).alias("train_source"), origin.alias("origin"),
    )


def merge_schemas(train: DataFrame, new: DataFrame, flags: Sequence[str], group: Sequence[str] = (), key: Key = md5_key) -> DataFrame:
    """The union of both by key: train gives label and source (its last row wins), new gives the largest of each flag.

    train: text, label_name, source, _ord; new: text, flags (0 or 1), _ord. origin is `both` for a key of train and new, or
    one that new holds at least twice (the second row meets what the first has put in); else train_only or new_only. The text
    is that of the train row that counts, else of the first row of new. Groups and flags have other names than these."""
    return merged_view(key_states(train, new, flags, group, key), flags, group)


def _buckets(path: str) -> int:
    """The number of buckets that a version's files lie in."""
    return int(_CORPUS.search(path)[2])


class KeyedCorpus:
    """A merged corpus on disk that grows by batches, as states by key in files bucketed by (h1, h2).

    A batch is brought to one row a key, dealt by the same buckets and joined; the corpus itself is read bucket by bucket and
    never shuffled. Versions are whole folders under root that count once their _SUCCESS mark is there; a batch's number is
    its version, so one that runs again after a death is absorbed once. The last `retain` versions before the newest stay
    for readers. The number of buckets is in a version's name; a changed number holds from the next batch on. The catalogue's
    entry is made anew in each session. One writer at a time; take at least as many buckets as spark.sql.shuffle.partitions,
    or Spark may prefer to deal both sides anew."""

    def __init__(self, spark: SparkSession, root: str, flags: Sequence[str], group: Sequence[str] = (), buckets: int = 256, retain: int = 1, key: Key = md5_key):
        self.spark, self.root, self.flags, self.group, self.buckets, self.retain, self.key = spark, root, list(flags), list(group), buckets, retain, key

    def _table(self, version: int) -> str:
        return f"sieveline_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}_{version:010d}"

    def versions(self) -> list[tuple[int, str]]:
        return io.finished(self.spark, self.root, _CORPUS)

    def states(self) -> DataFrame | None:
        """The newest version, as a bucketed table; None before the first batch."""
        versions = self.versions()
        if not versions:
            return None
        version, path = versions[-1]
        name = self._table(version)
        if not self.spark.catalog.tableExists(name):
            cols = self.spark.read.parquet(path).schema.toDDL()
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {_buckets(path)} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def grown(self, train: DataFrame | None, new: DataFrame | None) -> DataFrame:
        """The states with a batch in them, not yet written."""
        batch, known = key_states(train, new, self.flags, self.group, self.key), self.states()
        return batch if known is None else absorbed(known, batch, self.flags, self.group)

    def absorb(self, version: int, train: DataFrame | None = None, new: DataFrame | None = None) -> None:
        """Takes in a batch; versions grow. One that is there already is left as it is."""
        done = self.versions()
        if done and version <= done[-1][0]:
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")  # the entry of a run that died; its files are written over
        grown = self.grown(train, new)
        if not done or _buckets(done[-1][1]) != self.buckets:
            grown = grown.repartition(self.buckets, "h1", "h2")  # later ones lie so already; one file a bucket
        path = f"{self.root}/corpus-{version:010d}-{self.buckets}"
        grown.write.mode("overwrite").format("parquet").option("path", path).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(self._table(version))
        for n, at in done[: max(0, len(done) - self.retain)]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
            io.delete(self.spark, at)

    def view(self) -> DataFrame:
        return merged_view(self.states(), self.flags, self.group)


def corpus_summary(merged: DataFrame, flags: Sequence[str], target: int, group: str = "language") -> DataFrame:
    """One row a (group, label_type, label): labels and raw flags, per group and for ALL, and meta rows per group.

    Labels, flags and origins are counted in one pass of grouping sets over the unpivoted rows, narrow before the shuffle."""

    def item(kind: str, label: Column, on: Column) -> Column:
        return F.struct(F.lit(kind).alias("label_type"), label.alias("label"), on.alias("on"))

    items = [item("label_name", F.col("label_name"), F.col("label_name") != ""), *(item("raw_label", F.lit(f), F.col(f) == 1) for f in flags)]
    items += [item("meta", F.lit("total_rows="), F.lit(True)), item("meta", F.concat(F.lit("origin_"), F.col("origin")), F.lit(True))]
    long = merged.select(group, F.explode(F.array(*items)).alias("x")).select(group, "x.*").where((F.col("label_type") == "raw_label") | F.col("on"))
    counts = long.groupingSets([[group, "label_type", "label"], ["label_type", "label"]], group, "label_type", "label").agg(F.grouping(group).alias("all"), F.count_if("on").alias("current_count"))
    n, meta = F.col("current_count"), F.col("label_type") == "meta"
    return counts.where(~meta | (F.col("all") == 0)).select(
        F.when(F.col("all") == 1, "ALL").otherwise(F.col(group)).alias(group), "label_type", F.when(meta & (F.col("label") == "total_rows="), F.concat("label", n.cast("string"))).otherwise(F.col("label")).alias("label"), "current_count",
        F.when(~meta, F.greatest(F.lit(target) - n, F.lit(0)).cast("long")).alias("need"), F.when(~meta, F.round(n / target * 100, 1)).alias("pct_of_target"),
    )


def schema_mismatch(merged: DataFrame, flags: Sequence[str], neutral: str = "safe", group: str = "language") -> DataFrame:
    """Among rows of both schemas: neutral with a flag, or not neutral without one."""
    safe = F.col("label_name") == neutral
    wrong = (safe & any_flag(flags)) | (~safe & ~any_flag(flags))
    return merged.where("origin = 'both'").groupBy(group).agg(F.count("*").alias("both_rows"), F.count_if(wrong).alias("mismatches"))


def distribution(df: DataFrame, label: str, allowed: Sequence[str], target: int) -> DataFrame:
    """Counts and gaps of exactly these labels, absent ones as 0."""
    spark = df.sparkSession
    cfg = spark.createDataFrame([(x,) for x in allowed], f"{label} string")
    counts = df.where(F.col(label).isin(*allowed)).groupBy(label).agg(F.count("*").alias("n"))
    return cfg.join(counts, label, "left").select(label, F.coalesce("n", F.lit(0)).alias("count"), F.greatest(F.lit(target) - F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("gap"))


def value_counts(df: DataFrame, col: str, order: str = "_ord") -> DataFrame:
    """Counts, with the place of first appearance that breaks ties."""
    return df.groupBy(col).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts by row and column with margins named All."""
    c = df.cube(row, col).agg(F.count("*").alias("n"), F.grouping(row).alias("gr"), F.grouping(col).alias("gc"))
    named = c.select(F.when(F.col("gr") == 1, "All").otherwise(F.col(row)).alias(row), F.when(F.col("gc") == 1, "All").otherwise(F.col(col)).alias("c"), "n")
    return named.groupBy(row).pivot("c", [*values, "All"]).agg(F.sum("n")).na.fill(0)


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts by row and column as one row each, zero for pairs that don't occur, with margins named All, for any number of
    columns."""
    n = df.groupBy(row, col).agg(F.count("*").alias("n"))
    cells = n.select(row).distinct().crossJoin(n.select(col).distinct()).withColumn("n", F.lit(0).cast("long"))
    c = n.unionByName(cells).cube(row, col).agg(F.sum("n").alias("n"), F.grouping(row).alias("gr"), F.grouping(col).alias("gc"))
    return c.select(F.when(F.col("gr") == 1, "All").otherwise(F.col(row)).alias(row), F.when(F.col("gc") == 1, "All").otherwise(F.col(col)).alias(col), "n")


def add_groups(df: DataFrame, source: str, groups: Mapping[str, str], other: str = "other") -> DataFrame:
    m = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv])
    return df.withColumn("source_group", F.coalesce(m[F.col(source)], F.lit(other)))


def ratio_to_need(selected: Column, need: Column) -> Column:
    """Half-even to three places; null without a need."""
    return F.when(need != 0, F.bround(selected / need, 3))

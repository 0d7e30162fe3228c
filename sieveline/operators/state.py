"""Resumable runs: what is left, where to stop, what a retry log says, how a loop goes on."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import unused
from ..functions.text import Key, lower_key
from ..sources.tables import finished, path_exists, settled, work_path
from .dedup import exclude_ids, keep_first
from .keystore import KeyStore, keyed


def remaining(df: DataFrame, done: DataFrame | None, id_col: str) -> DataFrame:
    """Rows of a resumed run; without a checkpoint, all."""
    return df if done is None else exclude_ids(df, done, id_col)


def before_first(df: DataFrame, incomplete: Column, order: str) -> DataFrame:
    """Strict mode: the rows before the first incomplete one, all where there is none."""
    (at,) = unused(df, "stop")
    stop = df.where(incomplete).agg(F.min(order).alias(at))
    return df.crossJoin(F.broadcast(stop)).where(F.col(at).isNull() | (F.col(order) < F.col(at))).drop(at)  # one row


def last_attempt(log: DataFrame, keys: Sequence[str], attempt: str) -> DataFrame:
    rest = [c for c in log.columns if c not in keys]
    best = F.max(F.struct(F.col(attempt).alias("__a"), F.struct(*rest).alias("__r")))
    return log.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.__r.*")


def next_batch(ids: DataFrame, id_col: str, labels: Sequence[str]) -> DataFrame:
    """The next batch number of each label, from ids like label__batch_0007."""
    cfg = ids.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    n = ids.select(F.regexp_extract(id_col, r"^(.*)__batch_\d+$", 1).alias("label"), F.regexp_extract(id_col, r"__batch_(\d+)$", 1).try_cast("int").alias("n")).groupBy("label").agg(F.max("n").alias("n"))
    return cfg.join(n, "label", "left").select("label", (F.coalesce("n", F.lit(-1)) + 1).alias("next_batch"))


def next_label(gaps: DataFrame, label: str, gap: str, order: Sequence[str], batch: int) -> DataFrame:
    """The label with the largest gap (the first of the order on ties) and how many rows to ask for."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(label))
    best = gaps.where(F.col(gap) > 0).agg(F.max(F.struct(F.col(gap).alias("gap"), (-place).alias("p"), F.col(label).alias("label"))).alias("b")).where("b IS NOT NULL")
    return best.select("b.label", F.col("b.gap").alias("gap"), F.least(F.lit(batch), F.greatest("b.gap", F.lit(5))).cast("long").alias("ask"))


_ROUND = re.compile(r"round-(\d{10})$")


def fill_to_target(
    main: DataFrame, ask: Callable[[str, int, int], DataFrame], labels: Sequence[str], target: int, max_rounds: int, batch: int,
    accept: Callable[[DataFrame, str], DataFrame] = lambda rows, label: rows, label: str = "final_category", text: str = "clean_text", key: Key = lower_key, root: str | None = None,
) -> tuple[DataFrame, int]:
    """Generates until each label has `target` rows or max_rounds are over: (main with the new rows, rounds made).

    Each round asks for up to `batch` rows of the label with the largest gap (the first of the list on ties), keeps those that
    `accept` lets through and whose key is new, and writes them. ask(label, n, round) gives rows with text and _ord.

    main is read once, for the counts of its labels and its keys; both are then kept up by what a round brings, so that a
    round costs its own rows: its keys look up their buckets of the key store, its rows are counted and added. With a root of
    the caller's, rounds that are there count, and a run that died goes on after the last whole one (main unchanged)."""
    spark = main.sparkSession
    root = root or work_path(spark, "fill")
    store = KeyStore(spark, f"{root}/keys")
    if not path_exists(spark, f"{root}/counts/_SUCCESS"):
        m, h1, h2 = keyed(main.select(label, text), key(F.col(text)))
        narrow = settled(m.select(label, F.col(h1).alias("h1"), F.col(h2).alias("h2"), (key(F.col(text)) == "").alias("blank")), "narrow")
        store.add(0, narrow.where("NOT blank"))
        narrow.where(F.col(label).isin(*labels)).groupBy(label).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/counts")
    counts = dict.fromkeys(labels, 0) | {r[label]: r["n"] for r in spark.read.parquet(f"{root}/counts").collect()}  # a row a label
    done = finished(spark, root, _ROUND)
    if done:
        for r in _rounds(spark, done).groupBy(label).agg(F.count("*").alias("n")).collect():
            counts[r[label]] += r["n"]
        last = done[-1]  # its keys may not have been added yet
        store.add(last[0] + 1, _keys(spark.read.parquet(last[1])))
    while len(done) < max_rounds:
        name = max(labels, key=lambda x: target - counts[x], default=None)
        gap = target - counts[name] if name is not None else 0
        if gap <= 0:
            break
        k = len(done)
        rows = accept(ask(name, min(batch, max(gap, 5)), k).withColumn(label, F.lit(name)), name)
        rows, h1, h2 = keyed(keep_first(rows, key(F.col(text))), key(F.col(text)))
        named = rows.withColumnsRenamed({h1: "__h1", h2: "__h2"}).withColumn("__blank", key(F.col(text)) == "")
        fresh = store.unseen(settled(named, "candidates"), "__h1", "__h2", k + 1).orderBy("_ord").limit(gap)
        path = f"{root}/round-{k:010d}"
        fresh.write.mode("overwrite").parquet(path)
        done.append((k, path))
        got = spark.read.parquet(path)
        counts[name] += got.count()
        store.add(k + 1, _keys(got))
        store.compact()
    return (main.unionByName(_rounds(spark, done).drop("__h1", "__h2", "__blank"), allowMissingColumns=True) if done else main), len(done)


def _rounds(spark: SparkSession, done: list[tuple[int, str]]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(*[p for _, p in done])


def _keys(got: DataFrame) -> DataFrame:
    return got.where("NOT __blank").select(F.col("__h1").alias("h1"), F.col("__h2").alias("h2"))


def run_status(report: DataFrame, target: int, max_retry: int) -> DataFrame:
    """final_total_count, gap_remaining and status of a generation report's rows; the first case that holds decides."""
    total = F.col("original_unique_count") + F.col("accepted_main_count")
    gap = F.greatest(F.lit(target) - total, F.lit(0))
    status = (
        F.when(F.col("original_unique_count") >= target, "already_enough").when(gap == 0, "completed").when(F.col("retry_count") >= max_retry, "not_enough_after_retry")
        .when((F.col("parse_error_count") > 0) & (F.col("generated_request_count") == 0), "failed_parse").otherwise("error")
    )
    return report.withColumns({"final_total_count": total, "gap_remaining": gap, "status": status})


def add_counters(prior: DataFrame, batch: DataFrame, label: str, reasons: Mapping[str, str]) -> DataFrame:
    """Rejection counters by label: those of the prior report and those of this batch (columns label, reason)."""
    c = batch.groupBy(label).agg(*[F.count_if(F.col("reason") == r).alias(name) for name, r in reasons.items()])
    both = prior.select(label, *reasons).unionByName(c)
    return both.groupBy(label).agg(*[F.sum(name).alias(name) for name in reasons])

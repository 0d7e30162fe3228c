"""Streaming forms, resumable: a log of raw rows into an upserted checkpoint, a bounded-state dedup, the rebuild of a corpus and a
circuit breaker. State that Spark doesn't keep itself is written by batch, so that a batch that runs again changes nothing."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import Key, lower_key
from ..operators.dedup import failed_run, keep_first
from ..operators.keystore import KeyStore, keyed
from ..sources.tables import delete, finished, settled, upsert


def upsert_stream(log: DataFrame, path: str, checkpoint: str, key: str, order: str, available_now: bool = True) -> StreamingQuery:
    """Each micro-batch is one idempotent upsert (the last row of a key wins), so a batch that runs again changes nothing."""
    spark = log.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        upsert(spark, path, batch, key, order)

    w = log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_log(spark: SparkSession, path: str, schema: str, files_each: int | None = 100) -> DataFrame:
    """With files_each=None a batch is all that has come since the last one: a stream that runs after each append, however many
    tasks wrote it, has one batch an append, so that batches come in the order of the appends."""
    log = spark.readStream.schema(schema)
    return (log if files_each is None else log.option("maxFilesPerTrigger", files_each)).parquet(path)


def distinct_stream(log: DataFrame, text: str, ts: str, delay: str, key: Key = lower_key) -> DataFrame:
    """The first row of a key within the watermark's delay; state, two longs a key, that is older than that is dropped."""
    d, h1, h2 = keyed(log.withWatermark(ts, delay), key(F.col(text)))
    return d.dropDuplicatesWithinWatermark([h1, h2]).drop(h1, h2)


_BATCH = re.compile(r"batch-(\d{10})$")


def _earlier(spark: SparkSession, root: str, batch: int) -> DataFrame | None:
    """The last whole batch of a state before this one: what a batch that runs again has seen the first time."""
    found = [p for n, p in finished(spark, root, _BATCH) if n < batch]
    return spark.read.parquet(found[-1]) if found else None


def _thin(spark: SparkSession, root: str, keep: int = 2) -> None:
    """A state's batches that no replay can ask for go."""
    delete(spark, *[p for _, p in finished(spark, root, _BATCH)[:-keep]])


def sunk(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows that a stream below has let through; None where it has written none yet."""
    found = [p for _, p in finished(spark, f"{root}/rows", _BATCH)]
    return spark.read.parquet(*found) if found else None


def rebuild_stream(log: DataFrame, valid: Callable[[DataFrame], DataFrame], text: str, order: str, ts: str, delay: float, root: str, key: Key = lower_key) -> StreamingQuery:
    """The rows of a log that are valid and the first of their key, written to root/rows as they come (see `sunk`).

    Within a batch the least order decides, between batches the earlier one. A batch's keys, two longs each, are looked up in
    and added to a key store; keys last seen more than `delay` seconds before the latest time go from it when it is
    compacted, and rows that come later than that are dropped, so that the state follows the delay and not the log. Rows without a time are never late, their keys never go. A batch
    that runs again sees the state that it saw first and overwrites what it wrote."""
    spark = log.sparkSession
    store, span = KeyStore(spark, f"{root}/keys"), int(delay * 1_000_000)

    def write(batch: DataFrame, number: int) -> None:
        seen = _earlier(spark, f"{root}/time", number)
        latest = seen.first()["latest"] if seen is not None else None
        time = F.unix_micros(ts)
        rows = batch if latest is None else batch.where(F.col(ts).isNull() | (time >= latest - span))
        rows, h1, h2 = keyed(keep_first(valid(rows), key(F.col(text)), order), key(F.col(text)))
        found = settled(rows, "candidates")
        path = f"{root}/rows/batch-{number:010d}"
        store.unseen(found, h1, h2, number).drop(h1, h2).write.mode("overwrite").parquet(path)
        # keys that came again count from their last time
        store.add(number, found.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), time.alias("at")), "at")
        now = batch.agg(F.greatest(F.max(time), F.lit(latest).cast("long")).alias("latest"))
        now.write.mode("overwrite").parquet(f"{root}/time/batch-{number:010d}")
        _thin(spark, f"{root}/time")
        if latest is not None:
            store.compact(latest - span)

    return log.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


class Tripped(Exception):
    """The breaker has stopped its query."""


def breaker_stream(log: DataFrame, bad: Column, run: int, order: str, root: str) -> StreamingQuery:
    """A circuit breaker over a log whose batches come in order: rows go to root/rows (see `sunk`) until `run` bad ones have
    come in succession, across batches or not; those are dropped and the query ends with an error (`Tripped`).

    The bad rows at a batch's end, fewer than `run`, are the state: they are held back until a good row or the run's end
    decides over them; `breaker_rows` counts them in. A restarted query that has tripped trips again."""
    spark = log.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        held = _earlier(spark, f"{root}/held", number)
        rows = settled(batch if held is None else batch.unionByName(held), "batch")
        wrong = F.coalesce(bad, F.lit(False))
        ends = failed_run(rows, bad, run, order).first()
        good = rows.where(~wrong).agg(F.max(order)).first()[0]
        if ends["start_at"] is not None:
            through, left = rows.where(F.col(order) < F.lit(ends["start_at"])), rows.limit(0)
        elif good is None:
            through, left = rows.limit(0), rows
        else:
            through, left = rows.where(F.col(order) <= F.lit(good)), rows.where(F.col(order) > F.lit(good))
        through.write.mode("overwrite").parquet(f"{root}/rows/batch-{number:010d}")
        if ends["start_at"] is not None:
            raise Tripped(f"{run} bad rows in succession from {ends['start_at']} to {ends['stop_at']}")
        left.write.mode("overwrite").parquet(f"{root}/held/batch-{number:010d}")
        _thin(spark, f"{root}/held")

    return log.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def breaker_rows(query: StreamingQuery, spark: SparkSession, root: str) -> tuple[DataFrame | None, bool]:
    """(the rows a breaker's query has let through, whether it has tripped), when the query has ended. Where it hasn't, bad
    rows still held count as through: there was no run."""
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if "Tripped" not in str(e):
            raise
        return sunk(spark, root), True
    rows, held = sunk(spark, root), _earlier(spark, f"{root}/held", 1 << 62)
    return (rows if held is None else held if rows is None else rows.unionByName(held)), False

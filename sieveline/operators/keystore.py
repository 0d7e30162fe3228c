"""A growing set of keys on disk, so that a round or a batch costs what it brings and not what there is already.

Keys are two longs with a time (any number that grows), in versions: one a round or batch, written whole before it counts (its _SUCCESS mark). Within a
version they lie in folders by bucket; a lookup reads the buckets that its own keys fall into, without moving what is stored.
Versions of rounds that ran again overwrite their own and only earlier ones are looked up, so a replay gives what the first
run gave. One writer at a time."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import halves, unused
from ..sources.tables import delete, finished, settled

SCHEMA = "h1 long, h2 long, at long, version int, bucket int"
#: Candidates up to this number of rows (two longs each) are sent to the stored keys instead of the other way round.
FEW = 100_000
_AT = re.compile(r"version=(\d{10})$")


class KeyStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, compact_every: int = 32):
        self.spark, self.root, self.buckets, self.compact_every = spark, root, buckets, compact_every

    def versions(self) -> list[tuple[int, str]]:
        return finished(self.spark, self.root, _AT)

    def _bucket(self, h1: str) -> Column:
        return F.pmod(F.col(h1), F.lit(self.buckets)).cast("int")

    def stored(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """h1, h2, at of the versions with smaller numbers."""
        paths = [p for n, p in self.versions() if before is None or n < before]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA).drop("version", "bucket")
        df = self.spark.read.schema(SCHEMA).option("basePath", self.root).parquet(*paths)
        return (df if buckets is None else df.where(F.col("bucket").isin(buckets))).drop("version", "bucket")

    def add(self, version: int, keys: DataFrame, at: str | None = None) -> None:
        """keys: h1, h2 and, if named, the time they were seen."""
        k = keys.groupBy("h1", "h2").agg(F.max(F.col(at) if at else F.lit(None).cast("long")).alias("at")).withColumn("bucket", self._bucket("h1"))
        k.repartition("bucket", F.pmod("h2", F.lit(8))).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/version={version:010d}")

    def unseen(self, rows: DataFrame, h1: str, h2: str, before: int | None = None) -> DataFrame:
        """rows, a written table, without those whose key an earlier version has."""
        mine = rows.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"))
        buckets = [r[0] for r in mine.select(self._bucket("h1")).distinct().collect()]  # self.buckets rows at most
        theirs = self.stored(before, buckets).select("h1", "h2")
        if rows.count() > FEW:
            return rows.join(theirs.select(F.col("h1").alias(h1), F.col("h2").alias(h2)), [h1, h2], "left_anti")
        met = theirs.join(F.broadcast(mine), ["h1", "h2"], "left_semi").select(F.col("h1").alias(h1), F.col("h2").alias(h2))
        return rows.join(F.broadcast(met), [h1, h2], "left_anti")

    def compact(self, oldest: int | None = None) -> None:
        """From compact_every versions on: one instead, without keys last seen before `oldest`."""
        versions = self.versions()
        if len(versions) < self.compact_every:
            return
        kept = self.stored()
        if oldest is not None:
            kept = kept.where(F.col("at").isNull() | (F.col("at") >= oldest))
        last = versions[-1][0]
        self.add(last, settled(kept, "keys"), "at")  # holds all of the others; a crash before they go leaves keys twice, which is one set
        delete(self.spark, *[p for n, p in versions if n != last])


def keyed(df: DataFrame, key: Column) -> tuple[DataFrame, str, str]:
    """df with the two longs of a key, and their names."""
    h1, h2 = unused(df, "h1", "h2")
    a, b = halves(key)
    return df.withColumns({h1: a, h2: b}), h1, h2

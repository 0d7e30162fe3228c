"""Shared Spark helpers: work tables in the cluster's shared folder, row keys, partition counts."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_LONG = -(2**63)
MOST_PARTS = 20_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where a local session names none (tests), one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


class Work:
    """Intermediate tables of one operator call, written to the shared folder so that lost executors cost no recomputation.

    Results are lazy and may read them as long as the session lives; the folder goes when the driver's JVM ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
        self.n = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if self.n == 1:
            fs, root = self._file_system(self.root)
            fs.deleteOnExit(root)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[out] = path
        return out

    def _file_system(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that nothing lazy reads any more."""
        for df in frames:
            if path := self.paths.pop(df, None):
                fs, p = self._file_system(path)
                fs.delete(p, True)


def keyed(df: DataFrame, id_col: str, *cols: str) -> DataFrame:
    """Only the columns asked for, with a key (k1, k2) of id and content. Null ids and repeated rows are legal: rows
    that agree in id and content are interchangeable, so they may share a key."""
    return df.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(MIN_LONG)).alias("k1"),
        F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("k2"),
        F.col(f"`{id_col}`").cast("long").alias(id_col),
        *[F.col(f"`{c}`") for c in cols],
    )


def parts_for(spark: SparkSession, amount: float, each: float) -> int:
    """So many partitions that each holds about `each` of `amount`, but no more than MOST_PARTS, beyond which the driver couldn't
    hold where the pieces of a shuffle are: a task then takes several groups, one after the other."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), min(MOST_PARTS, math.ceil(amount / each)))

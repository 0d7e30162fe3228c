"""Scans and sinks of the curation jobs: CSV with its three null conventions, parquet, padding, checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.flags import padded

#: Cells that a type-inferring CSV scan takes for missing (fixed values).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def work_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that driver and executors share; a local session that names none gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def settled(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage of a fold and survives lost executors. The files go when
    the driver's JVM ends."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)


def finished(spark: SparkSession, root: str, name: re.Pattern) -> list[tuple[int, str]]:
    """The numbered folders of root that were written whole, (number, path) in order; the pattern's first group is the number."""
    fs, p = _file_system(spark, root)
    if not fs.exists(p):
        return []
    found = [(int(m[1]), s.getPath()) for s in fs.listStatus(p) if (m := name.search(s.getPath().getName()))]
    return sorted((n, at.toString()) for n, at in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str | list[str], line_ends: bool = True) -> DataFrame:
    """All strings, any byte-order mark dropped; a missing cell is null. Cells may hold line ends, so that a file can't be
    split: many files are read by many tasks, but a large one by one. Where no cell does, line_ends=False splits files."""
    return spark.read.csv(path, header=True, multiLine=line_ends, quote='"', escape='"', inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_csv_strict_strings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As read_csv, but a missing cell is empty and NA stays NA."""
    return read_csv(spark, path).fillna("")


def read_csv_inferred(spark: SparkSession, path: str | list[str], types: dict[str, str]) -> DataFrame:
    """As read_csv, then the usual spellings of a missing value are null and the named columns are cast, bad cells to null."""
    df = read_csv(spark, path)
    cells = {c: F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in df.columns}
    return df.select(*[(cells[c].try_cast(types[c]) if c in types else cells[c]).alias(c) for c in df.columns])


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: .csv, else parquet."""
    return read_csv(spark, path) if path.lower().endswith(".csv") else spark.read.parquet(path)


def read_pruned(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only these columns, absent ones tolerated; the scan reads no others."""
    df = read_any(spark, path)
    return df.select(*[c for c in columns if c in df.columns])


def read_or_empty(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The table, or an empty one with these columns where the path is absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return read_any(spark, path)


def read_required(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    df = read_any(spark, path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} lacks columns {missing}")
    return df


def unknown_labels(df: DataFrame, label: str, allowed: Sequence[str]) -> DataFrame:
    """Labels outside the allowed ones with their counts."""
    return df.where(F.col(label).isNotNull() & ~F.col(label).isin(*allowed)).groupBy(label).agg(F.count("*").alias("n"))


def read_padded(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return padded(read_any(spark, path), columns, "")


def read_many(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame | None, list[str]]:
    """The union by name of those that exist, each row tagged with its source_file; the missing paths."""
    out, missing = None, []
    for p in paths:
        if not path_exists(spark, p):
            missing.append(p)
            continue
        df = read_any(spark, p).withColumn("source_file", F.lit(p))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, missing


def latest(spark: SparkSession, pattern: str) -> str | None:
    """The newest path that matches a glob, by modification time, then name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    best = max(found, key=lambda s: (s.getModificationTime(), s.getPath().toString()), default=None)
    return best.getPath().toString() if best is not None else None


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    out = df.select(*columns) if columns else df
    out.write.mode(mode).csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def export_csv_with_bom(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    """A report for spreadsheets: one file whose first header begins with a byte-order mark. For small results."""
    out = df.select(*[F.col(c).alias(("﻿" if i == 0 else "") + c) for i, c in enumerate(columns)])
    write_csv(out.coalesce(1), path)
    return path


def append_log(df: DataFrame, path: str) -> None:
    """An at-least-once log; readers make it exact by keep_last."""
    df.write.mode("append").parquet(path)


def write_split(df: DataFrame, main: str, main_columns: Sequence[str], side: str, side_columns: Sequence[str]) -> None:
    """The main file without, and a sidecar with, the columns that must not be seen together; one computation for both."""
    kept = df.persist()
    try:
        kept.select(*main_columns).write.mode("overwrite").parquet(main)
        kept.select(*side_columns).write.mode("overwrite").parquet(side)
    finally:
        kept.unpersist()


def write_triple(rows: DataFrame, label: str, target: int, root: str) -> None:
    """A run's main rows, its overflow and a report of counts by label, from rows with part main or overflow, which are
    computed once."""
    kept = settled(rows, "triple")
    for part in ("main", "overflow"):
        kept.where(F.col("part") == part).drop("part").write.mode("overwrite").parquet(f"{root}/{part}")
    n = F.count_if(F.col("part") == "main")
    report = kept.groupBy(label).agg(n.alias("main"), F.count_if(F.col("part") == "overflow").alias("overflow"), F.greatest(F.lit(target) - n, F.lit(0)).alias("still_needed"))
    report.write.mode("overwrite").parquet(f"{root}/report")


_VERSION = re.compile(r"(base|delta)-(\d{10})$")


def _every_version(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, kind, path) of all versions of a checkpoint, in order; kind is empty for one that wasn't written whole."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath(), m) for s in fs.listStatus(p) if (m := _VERSION.search(s.getPath().getName()))]
    return sorted((int(m[2]), m[1] if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")) else "", at.toString()) for at, m in found)


def _versions(spark: SparkSession, path: str) -> tuple[list[tuple[int, str, str]], int]:
    """The whole versions of a checkpoint that count, from the last base on, and the highest number there."""
    found = _every_version(spark, path)
    base = max((n for n, kind, _ in found if kind == "base"), default=0)
    return [x for x in found if x[1] and x[0] >= base], max((n for n, _, _ in found), default=0)


def read_checkpoint(spark: SparkSession, path: str, key: str, order: str) -> DataFrame | None:
    """The last row of each key of a checkpoint; None where there is none yet."""
    from ..operators.dedup import keep_last

    versions, _ = _versions(spark, path)
    both = None
    for _, _, at in versions:
        df = spark.read.parquet(at)
        both = df if both is None else both.unionByName(df, allowMissingColumns=True)
    if both is None or len(versions) == 1:  # a version holds a key once
        return both
    return keep_last(both, F.col(key).cast("string"), order)


def upsert(spark: SparkSession, path: str, rows: DataFrame, key: str, order: str, compact_every: int = 16, retain: int = 1) -> DataFrame:
    """Adds rows to a checkpoint, old and new columns by name; the last of each key counts. Returns the checkpoint.

    A checkpoint is a folder of numbered versions: a delta holds what one call brought, a base all before it. A version
    counts once its _SUCCESS mark is there, and nothing that counts is touched before what replaces it does, so a run
    that dies at any point leaves the last state. A call costs what it brings; after `compact_every` deltas a new base
    is written. What it replaces goes only when the base after it is written, or `retain` bases later: a frame that was
    returned before a compaction reads its own versions, which the frame names, until then. One writer at a time."""
    from ..operators.dedup import keep_last

    versions, top = _versions(spark, path)
    keep_last(rows, F.col(key).cast("string"), order).write.parquet(f"{path}/delta-{top + 1:010d}")
    if sum(kind == "delta" for _, kind, _ in versions) + 1 >= compact_every:
        read_checkpoint(spark, path, key, order).write.parquet(f"{path}/base-{top + 2:010d}")
        bases = sorted(n for n, kind, _ in _every_version(spark, path) if kind == "base")
        oldest = bases[-1 - retain] if len(bases) > retain else 0  # what came before this base is named by no frame that is still to be read
        delete(spark, *[at for n, _, at in _every_version(spark, path) if n < oldest])
    return read_checkpoint(spark, path, key, order)

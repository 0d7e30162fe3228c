"""Connected components by hooking and pointer jumping, and contiguous groups of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import Work


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, comp) for every node of edges(a, b): comp is the smallest node that can be reached.

    A round hears the least second label (the label's own label) among a node's neighbours, and lowers to it both the node's
    label and the label of that label, so that whole trees hook onto smaller ones; then labels jump to their own labels
    (FastSV). Rounds go on until no label changes: labels only fall and are nodes of their component, so this ends, and at
    the end neighbours agree. A round is two joins and two aggregations with map-side combining, and is written before the next."""
    e = edges.where("a <> b").select("a", "b")
    e = work.keep(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = work.keep(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels0")

    def total(of: DataFrame):
        return of.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]

    before = total(labels)
    for k in count(1):
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        second = labels.join(up, "comp").select("node", "comp", "top")
        heard = e.join(second.select(F.col("node").alias("b"), "top"), "b").select(F.col("a").alias("node"), F.lit(None).cast("long").alias("comp"), "top")
        least = second.unionByName(heard).groupBy("node").agg(F.max("comp").alias("comp"), F.min("top").alias("top"))  # one row has comp
        lowered = least.select(F.explode(F.array(F.struct("node", F.col("top").alias("comp")), F.struct(F.col("comp").alias("node"), F.col("top").alias("comp")))).alias("x")).select("x.*")
        new = lowered.groupBy("node").agg(F.min("comp").alias("comp"))
        kept = work.keep(new, f"labels{k}")
        now = total(kept)  # labels only ever fall, so an equal sum means that none has changed
        work.drop(labels)
        labels, same, before = kept, now == before, now
        if same:
            break
    work.drop(e)
    return labels


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of a column by which the batches are sorted, and the first row of each group (+ end)."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(k[1:] != k[:-1]) + 1
        starts_new = last is not None and k[0] != last
        last = k[-1]
        if not len(change) and not starts_new:
            rest.append(batch)
            continue
        cut = int(change[-1]) if len(change) else 0
        done = [*rest, batch.slice(0, cut)] if cut else rest
        if done:
            yield _framed(done, key)
        rest = [batch.slice(cut)]
    if rest:
        yield _framed(rest, key)


def _framed(parts: list[pa.RecordBatch], key: str) -> tuple[pa.Table, np.ndarray]:
    t = pa.Table.from_batches(parts).combine_chunks()
    k = t.column(key).to_numpy()
    return t, np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over pairs (a, b)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def blocked(rows: DataFrame, size: str, limit: int, node: str, *key: str) -> DataFrame:
    """Adds task (long) and side to the rows of groups `key` of `size` rows each. A group over `limit` is cut into blocks
    by a hash of the node; each pair of blocks is a task of its own (side 1 and 2: only pairs across count; side 0: all),
    so that a task holds about 2 * limit rows at most and every pair of the group meets in exactly one task."""
    nb = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    own = F.pmod(F.xxhash64(F.col(node), F.lit("block")), nb.cast("long")).cast("int")
    r = rows.withColumns({"__nb": nb, "__own": own}).withColumn("__other", F.explode(F.when(nb == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), nb - 1))))
    task = F.xxhash64(*[F.col(c) for c in key], F.least("__own", "__other"), F.greatest("__own", "__other"))
    side = F.when(F.col("__own") == F.col("__other"), 0).when(F.col("__own") < F.col("__other"), 1).otherwise(2)
    return r.withColumns({"task": task, "side": side.cast("int")}).drop("__nb", "__own", "__other")

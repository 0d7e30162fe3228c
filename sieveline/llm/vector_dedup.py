"""Near-duplicate vectors by Euclidean p-stable hashing.

For unit vectors cos >= s means a distance of at most sqrt(2 - 2 s). A hash is floor((a . x + b) / w) with Gaussian a; k of
them make a table's key, and L tables are looked up. k follows log n (the number of unrelated vectors in a bucket stays
constant), and L the chance that a pair at the very threshold meets in one table, so that `recall` of such pairs is
reached; closer pairs are found more surely. Vectors that share a bucket are compared by exact cosine in double precision.

Equal vectors are one node with a count. Where the same nodes share a bucket in several tables, the first
counts. Buckets over `BLOCK` nodes are cut into pairs of blocks, compared as matrix products, so none is capped. A pair counts in the first table in which it meets; what leaves a task is a count and a root
a node, never the pairs.

Defined results: vectors that are null or empty, have a null or non-finite component or no length link with nothing, are
their own component and kept; vectors of different lengths never link; rows that repeat a vector link with each other,
whatever their ids; a null vec_id has a null component_id only if all it reaches are null, and is not kept unless so; an
empty table gives an empty result; labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import blocked, components, local_roots, whole_groups
from ._spark import Work, parts_for
from ._units import mix, signed, tidy

COSINE, WIDTH, RECALL, SEED, BLOCK = 0.9, 2.0, 0.98, 77, 512
SPREAD = 2


def collision(distance: float, width: float) -> float:
    """Chance that one hash of two vectors at this distance agrees."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def parameters(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(hashes a table, tables) for n vectors."""
    near, far = collision(math.sqrt(2 - 2 * cosine), WIDTH), collision(math.sqrt(2), WIDTH)
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)) + SPREAD)
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


@lru_cache(4)
def _projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    a = rng.standard_normal((tables * k, dim))
    return a, rng.uniform(0, WIDTH, tables * k), rng.integers(1, 2**62, tables * k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def keys(unit: np.ndarray, k: int, tables: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """A key for every vector and table from lo to hi."""
    hi = tables if hi is None else hi
    a, b, salt = (x[lo * k : hi * k] for x in _projections(unit.shape[1], k, tables))
    h = np.floor((unit @ a.T + b) / WIDTH).astype(np.int64).view(np.uint64)
    return mix((h * salt).reshape(len(unit), hi - lo, k).sum(2, dtype=np.uint64) + np.arange(lo + 1, hi + 1, dtype=np.uint64) * np.uint64(unit.shape[1]))


def first_meetings(unit: np.ndarray, i: np.ndarray, j: np.ndarray, t: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Which pairs (i, j), found in table t, share no earlier table. Tables are hashed a few at a time, and only for pairs
    that are still undecided: near pairs meet early, so most drop out at once."""
    first = np.ones(len(i), bool)
    open_ = np.arange(len(i))
    for lo in range(0, tables, 8):
        open_ = open_[t[open_] > lo]
        if not len(open_):
            break
        hi = min(lo + 8, tables)
        for at in range(0, len(open_), 1 << 15):
            part = open_[at : at + (1 << 15)]
            used, inverse = np.unique(np.concatenate([i[part], j[part]]), return_inverse=True)
            key = keys(unit[used], k, tables, lo, hi)
            same = (key[inverse[: len(part)]] == key[inverse[len(part) :]]) & (np.arange(lo, hi) < t[part][:, None])
            first[part[same.any(1)]] = False
        open_ = open_[first[open_]]
    return first


def _units(col: pa.ListArray) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(k: int, tables: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, vec = batch.column("node").to_numpy(zero_copy_only=False), batch.column("vec")
            lens = np.diff(vec.offsets.to_numpy())
            for dim in np.unique(lens):
                rows = np.flatnonzero(lens == dim)
                for at in range(0, len(rows), 512):
                    part = rows[at : at + 512]
                    key = keys(_units(vec.take(pa.array(part))), k, tables)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(node[part], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))), pa.array(signed(key.reshape(-1)))], names=["node", "t", "key"]
                    )

    return tidy(f)


def _compared(k: int, tables: int, cosine: float):
    def pairs(unit: np.ndarray, first: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.diff(first)
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes <= 16
        for d in range(1, int(sizes[small].max(initial=0))):
            i = np.flatnonzero((group[d:] == group[:-d]) & small[group[d:]])
            i = i[np.einsum("ij,ij->i", unit[i], unit[i + d]) >= cosine]
            yield i, i + d
        for g in np.flatnonzero(~small):
            a, b = first[g], first[g + 1]
            i, j = np.nonzero(np.triu(unit[a:b] @ unit[a:b].T >= cosine, 1))
            yield a + i, a + j

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, "task"):
            node, mult, t, side = (table.column(c).to_numpy() for c in ("node", "mult", "t", "side"))
            vec = table.column("vec").combine_chunks()
            lens = np.diff(vec.offsets.to_numpy())
            out_n, out_r, out_l = [], [], []
            for dim in np.unique(lens):
                rows = np.flatnonzero(lens == dim)
                unit = _units(vec.take(pa.array(rows)))
                own = np.searchsorted(rows, first)
                found = [*pairs(unit, own, side[rows])]
                i = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
                j = np.concatenate([x for _, x in found]) if found else i
                gi, gj = rows[i], rows[j]
                ok = ((side[gi] == 0) | (side[gi] != side[gj])) & (node[gi] != node[gj])
                i, j, gi, gj = i[ok], j[ok], gi[ok], gj[ok]
                if not len(i):
                    continue
                used, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
                links = np.zeros(len(used), np.int64)
                ui, uj = inverse[: len(i)], inverse[len(i) :]
                now = first_meetings(unit, i, j, t[gi], k, tables)  # a pair counts once, in the first table in which it meets
                np.add.at(links, ui[now], mult[gj[now]])
                np.add.at(links, uj[now], mult[gi[now]])
                root = local_roots(len(used), ui, uj)
                out_n.append(node[rows[used]])
                out_r.append(node[rows[used[root]]])
                out_l.append(links)
            if out_n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_n, out_r, out_l)], names=["node", "root", "links"])

    return tidy(f)


def report(embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), kept."""
    spark = embeddings.sparkSession
    work = Work(spark, "vectors")
    kind = "double" if embeddings.schema["embedding"].dataType.simpleString() == "array<double>" else "float"
    e = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("vec"))
    fine = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    plain = F.transform("vec", lambda x: x + F.lit(0.0).cast(kind))  # -0 is 0
    e = e.withColumn("vec", F.when(fine & (length > 0), plain)).withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))
    nodes = work.keep(e.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("mult"), F.first("vec").alias("vec"), F.min("vec_id").alias("least")), "nodes")
    k, tables = parameters(nodes.count(), cosine, recall)
    hashed = work.keep(nodes.select("node", "vec").mapInArrow(_hashed(k, tables), "node long, t int, key long"), "keys")
    # of the tables in which the same vectors share a bucket, the first; only ids travel until then
    sign = (F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("s2"))
    shared = work.keep(hashed.groupBy("t", "key").agg(F.count("*").alias("m"), *sign).where("m > 1"), "shared")
    once = shared.groupBy("m", "s1", "s2").agg(F.min("t").alias("t"))
    shared = shared.join(once, ["m", "s1", "s2", "t"]).select("t", "key", "m")
    meets = work.keep(hashed.join(shared, ["t", "key"]), "meets")
    rows = blocked(meets, "m", BLOCK, "node", "t", "key").join(nodes.select("node", "mult", "vec"), "node").select("task", "side", "t", "node", "mult", "vec")
    n = parts_for(spark, meets.count(), 20_000)
    found = rows.repartition(n, "task").sortWithinPartitions("task").mapInArrow(_compared(k, tables, cosine), "node long, root long, links long")
    found = work.keep(found, "found")
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), work)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = nodes.select("node", "mult", "least").join(links, "node", "left").join(comp, "node", "left")
    of = of.select("node", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("comp", "node").alias("comp"), "least")
    top = of.groupBy("comp").agg(F.min("least").alias("component"))
    of = work.keep(of.join(top, "comp").select("node", "n_links", "component"), "classes")
    work.drop(nodes, hashed, found)
    out = e.select("vec_id", "node").join(of, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

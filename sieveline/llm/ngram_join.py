"""N-gram Jaccard join by chosen paths.

A document is its set of word shingles. A run splits all sets on a sampled shared token: the shingle that is least under a
random order of the run (so two sets fall together with chance J, and the token is in both). Buckets over `SPLIT` sets
are split again on the next sampled token, and after `DEPTH` tokens those over `LARGE` sets again, each on `TRIES` tokens side
by side, so that a pair is hardly ever parted there: as long as that leaves fewer pairs to compare, or until the sampled
tokens are spent. The sets at the end of one path form a bucket that is searched by brute force. Runs are repeated until a
pair at the threshold is found with chance `recall`.

Brute force has two steps, both inside a bucket: sketches (the least values of all runs) part the bucket into groups that
can hold a pair, then whole sets are intersected, as a product of incidence matrices. A group that holds the same sets as
one of an earlier run is dropped, and a pair counts in the first run whose path it shares. Buckets over `BLOCK` sets, or of
long sets, are cut into pairs of blocks, so nothing is capped; a task gives a count and a root a set, never its pairs.

Documents with equal shingle sets are one set with a count. Whole texts are used; words are runs of signs other than white
space, unchanged. A text of one to four words is one shingle, a text without words has no set.

Defined results: a null, empty or blank text links with nothing and is its own class; equal texts link, whatever their
ids; repeated rows are documents of their own; null ids are legal, a class's id is its least id that isn't null; an empty
table gives an empty result; other columns are ignored by `report` and kept by `one_each`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import row_lot, unused
from ._graph import blocked, components, local_roots, whole_groups
from ._spark import Work, keyed, parts_for
from ._units import PIECE, Prefix, groups, mix, raw, signed, tidy, words

WORDS, JACCARD, RECALL = 5, 0.8, 0.9995
SPLIT, DEPTH, BLOCK, SEED = 48, 3, 512, 4242
#: Buckets over LARGE sets are split on after DEPTH tokens, on TRIES tokens at each of DEEP levels.
LARGE, TRIES, DEEP = 4096, 3, 2
#: A bucket that holds more than this part of all paths is hot; so there are fewer of them than 1 / HOT at a level of one path a run.
HOT = 1 / 4096
#: Shingles of a set in a full block, on average; a bucket of longer sets is cut into more blocks.
SET_SIZE = 8192


def n_runs(jaccard: float, recall: float) -> int:
    """Runs until a pair at the threshold, on a path of full depth, is found with chance `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard**DEPTH))


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and each row's first (len + 1)."""
    values, first = words(data, offs)
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), np.where(n >= k, n - k + 1, n > 0))
    at = np.arange(len(rows)) - np.repeat(np.cumsum(np.bincount(rows, minlength=len(n))) - np.bincount(rows, minlength=len(n)), np.bincount(rows, minlength=len(n))) + first[rows]
    h = Prefix(values).hash(at, at + np.minimum(k, n[rows]))
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[new], np.searchsorted(rows[new], np.arange(len(n) + 1))


def _salts(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, n, dtype=np.uint64)


def _sketched(k: int, size: int):
    salts = _salts(size + 2)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = raw(batch.column("text"))
            for lo, hi in groups(offs):
                h, first = shingles(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], k)
                n = np.diff(first)
                full = np.flatnonzero(n)
                least = np.zeros((hi - lo, size), np.int32)
                fp = np.zeros((2, hi - lo), np.uint64)
                for j in range(size + 2 if len(full) else 0):
                    x = h ^ salts[j]  # a cheaper mix than mix(): one multiplication each way
                    x *= np.uint64(0x9FB21C651E98DF25)
                    x ^= x >> np.uint64(32)
                    x *= np.uint64(0xD6E8FEB86659FD93)
                    x ^= x >> np.uint64(32)
                    if j < size:
                        least[full, j] = np.minimum.reduceat(x, first[full]).astype(np.uint32).view(np.int32)
                    else:
                        fp[j - size, full] = np.add.reduceat(x, first[full])
                node = signed(mix(fp[0] + mix(fp[1] + n.astype(np.uint64))))
                mins = pa.ListArray.from_arrays(pa.array(np.arange(0, least.size + 1, size, dtype=np.int32)), pa.array(least.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in ("k1", "k2", "doc_id")), pa.array(n.astype(np.int32)), pa.array(node), mins], names=["k1", "k2", "doc_id", "n", "node", "mins"]
                )

    return tidy(f)


def _parted(size: int, least: float):
    """Groups of a bucket that may hold a pair, by the share of equal least values."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = math.ceil(size * least)
        for table, first in whole_groups(batches, "task"):
            task, node, side, r = (table.column(c).to_numpy() for c in ("task", "node", "side", "r"))
            mins = table.column("mins").combine_chunks().flatten().to_numpy().reshape(-1, size)
            sizes = np.diff(first)
            group = np.repeat(np.arange(len(sizes)), sizes)
            small = sizes <= 24
            ai, bi = [], []
            for d in range(1, int(sizes[small].max(initial=0))):
                i = np.flatnonzero((group[d:] == group[:-d]) & small[group[d:]])
                i = i[(mins[i] == mins[i + d]).sum(1) >= need]
                ai.append(i)
                bi.append(i + d)

            def joined(ai: list, bi: list, lo: int, hi: int) -> pa.RecordBatch | None:
                a = np.concatenate(ai) if ai else np.zeros(0, np.int64)
                b = np.concatenate(bi) if bi else a
                ok = (side[a] == 0) | (side[a] != side[b])  # noqa: B023
                a, b = a[ok] - lo, b[ok] - lo
                if not len(a):
                    return None
                root = local_roots(hi - lo, a, b) + lo
                used = np.unique(np.concatenate([a, b])) + lo
                part = signed(mix(task[used].view(np.uint64) + mix(root[used - lo].astype(np.uint64))))  # noqa: B023
                part = signed(mix(part.view(np.uint64) ^ mix(node[root[used - lo]].view(np.uint64))))  # noqa: B023
                return pa.RecordBatch.from_arrays([pa.array(part), pa.array(side[used]), pa.array(r[used]), pa.array(node[used])], names=["task", "side", "r", "node"])  # noqa: B023

            if batch := joined(ai, bi, 0, len(node)):
                yield batch
            for g in np.flatnonzero(~small):  # one at a time: a group of near copies has most of its pairs
                a, b = first[g], first[g + 1]
                part = mins[a:b]
                hits = [np.flatnonzero((part[i + 1 :] == part[i]).sum(1) >= need) for i in range(b - a - 1)]
                if batch := joined([np.full(len(h), a + i) for i, h in enumerate(hits)], [a + i + 1 + h for i, h in enumerate(hits)], a, b):
                    yield batch

    return tidy(f)


def _sets(k: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = raw(batch.column("text"))
            for lo, hi in groups(offs):
                h, first = shingles(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], k)
                body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer((first * 8).astype(np.int64)), pa.py_buffer(h)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), body], names=["node", "body"])

    return tidy(f)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over slabs of the shared elements."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1
    shared = counts[inverse] > 1
    row, col = row[shared], place[inverse[shared]]
    out = np.zeros((m, m), np.float32)
    width = int((counts > 1).sum())
    slab = max(256, (1 << 21) // m)
    order = np.argsort(col, kind="stable") if width > slab else np.arange(len(col))
    row, col = row[order], col[order]
    for a in range(0, width, slab):
        lo, hi = (np.searchsorted(col, [a, a + slab])) if width > slab else (0, len(col))
        x = np.zeros((m, min(slab, width - a)), np.float32)
        x[row[lo:hi], col[lo:hi] - a] = 1
        out += x @ x.T
    return out


def _verified(jaccard: float):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, "task"):
            node, side, r, mult = (table.column(c).to_numpy() for c in ("node", "side", "r", "mult"))
            body = table.column("body").combine_chunks()
            data, offs = raw(body)
            leaf = table.column("leaves").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                sets = [data[offs[i] : offs[i + 1]].view(np.uint64) if (offs[i] % 8 == 0) else np.frombuffer(data[offs[i] : offs[i + 1]].tobytes(), np.uint64) for i in range(a, b)]
                n = np.array([len(s) for s in sets], np.float32)
                both = overlaps(sets)
                i, j = np.nonzero(np.triu(both >= jaccard * (n[:, None] + n[None, :] - both) - 1e-3, 1))
                s = side[a:b]
                ok = ((s[i] == 0) | (s[i] != s[j])) & (node[a + i] != node[a + j])
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                links = np.zeros(b - a, np.int64)
                for c in range(0, len(i), 1 << 16):  # a pair counts only in the first run whose path it shares
                    p, q = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
                    now = (leaf[a + p] == leaf[a + q]).argmax(1) == r[a + p]
                    np.add.at(links, p[now], mult[a + q][now])
                    np.add.at(links, q[now], mult[a + p][now])
                used = np.unique(np.concatenate([i, j]))
                root = local_roots(b - a, i, j)
                for o, x in zip(out, (node[a + used], node[a + root[used]], links[used]), strict=True):
                    o.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["node", "root", "links"])

    return tidy(f)


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("leaf").agg(F.count("*").alias("m"), F.ceil(F.sum("n") / SET_SIZE).cast("long").alias("weight"))


def _met(rows: DataFrame, facts: DataFrame, most: float) -> DataFrame:
    """rows with the facts of their bucket (`leaf`, its size m, others). What lies in hot buckets, over `most` rows, never meets in
    one task: of these there are only so many as `HOT` allows, so their facts are broadcast."""
    hot = F.broadcast(facts.where(F.col("m") > most))
    return rows.join(hot, "leaf").unionByName(rows.join(hot.select("leaf"), "leaf", "left_anti").join(facts.where(F.col("m") <= most), "leaf"))


def _deeper(large: DataFrame, nodes: DataFrame, runs: int, most: float, work: Work) -> tuple[list[DataFrame], int]:
    """(ends (node, r, leaf, m, weight) of the paths in buckets over LARGE, number of runs these paths count as).

    Each try of each run is a run of its own from there on, with a number of its own, so a set has one path a run at most. The
    tokens are those that other runs sample: the orders that follow the run's own."""
    ends, ids, slots = [], runs, runs * DEPTH
    at = large.withColumn("at", F.col("r"))  # the run's place among those of this level
    for level in range(DEEP):
        if at.isEmpty():
            break
        at = work.keep(at.join(nodes.select("node", "mins"), "node"), f"large{level}")

        def tried(rows: DataFrame, *more: str) -> DataFrame:
            rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))))
            slot = F.col("first") * DEPTH + DEPTH + level * TRIES + F.col("j")  # noqa: B023
            token = F.col("mins")[F.pmod(slot, F.lit(slots))]
            place = F.col("at") * TRIES + F.col("j")
            return rows.select("node", "n", "first", (F.lit(ids) + place).alias("r"), place.alias("at"), F.xxhash64("leaf", "j", token).alias("leaf"), *more)  # noqa: B023

        # a bucket is split where that leaves half the pairs at most
        parts = tried(at.withColumns({"of": F.col("leaf"), "was": F.col("m")}), "of", "was").groupBy("leaf").agg(F.count("*").alias("k"), F.first("of").alias("of"), F.first("was").alias("was"))
        gain = parts.groupBy(F.col("of").alias("leaf")).agg(F.first("was").alias("m"), (2 * F.sum(F.col("k").cast("double") * F.col("k")) <= F.pow(F.first("was").cast("double"), F.lit(2.0))).alias("gains"))
        gain = work.keep(gain, f"gain{level}")
        known = _met(at.drop("m"), gain, most)
        ends.append(known.where("NOT gains").select("node", "r", "leaf", "m", "weight"))
        tries = work.keep(tried(known.where("gains")), f"tries{level}")
        sizes = work.keep(_sizes(tries).where("m > 1"), f"deep-sizes{level}")
        met = work.keep(_met(tries, sizes, most), f"deep{level}")
        ids += runs * TRIES ** (level + 1)
        last = level == DEEP - 1
        ends.append((met if last else met.where(F.col("m") <= LARGE)).select("node", "r", "leaf", "m", "weight"))
        at = met.where(F.col("m") > LARGE)
    return ends, ids


def classes(docs: DataFrame, k: int = WORDS, jaccard: float = JACCARD, recall: float = RECALL, work: Work | None = None) -> DataFrame:
    """k1, k2, doc_id, class_id, n_links, first for every row of docs; `first`: the key (k1, k2) that stands for the class."""
    spark = docs.sparkSession
    work = work or Work(spark, "ngrams")
    runs = n_runs(jaccard, recall)
    size = runs * DEPTH
    d = keyed(docs, "doc_id", "text")
    every = work.keep(d.mapInArrow(_sketched(k, size), "k1 long, k2 long, doc_id long, n int, node long, mins array<int>"), "sketches")
    nodes = every.where("n > 0").groupBy("node").agg(F.count("*").alias("mult"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "k1", "k2")).alias("rep"), F.min("doc_id").alias("least"), F.first("mins").alias("mins"), F.first("n").alias("n"))
    nodes = work.keep(nodes, "nodes")

    # paths: split by a sampled token, and buckets that are still large by the next one
    steps = [F.col("mins")[F.col("r") * DEPTH + i].alias(f"m{i}") for i in range(DEPTH)]
    open_ = nodes.select("node", "mins", "n", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("r")).select("node", "r", "n", *steps)
    open_ = open_.withColumn("leaf", F.xxhash64("r", "m0"))
    amount = nodes.count()
    most = amount * runs * HOT
    ends, levels = [], []
    for i in range(DEPTH):
        met = work.keep(_met(open_, work.keep(_sizes(open_).where("m > 1"), f"sizes{i}"), most), f"level{i}")
        levels.append(met)
        ends.append(met.where(F.col("m") <= (LARGE if i == DEPTH - 1 else SPLIT)).select("node", "r", "leaf", "m", "weight"))
        if i < DEPTH - 1:
            open_ = met.where(F.col("m") > SPLIT).drop("m", "weight").withColumn("leaf", F.xxhash64("leaf", f"m{i + 1}"))
    deep, paths = _deeper(met.where(F.col("m") > LARGE).select("node", "n", F.col("r").alias("first"), "r", "leaf", "m", "weight"), nodes, runs, most, work)
    leaves = reduce(DataFrame.unionByName, ends + deep).withColumn("m", F.greatest("m", F.least(F.col("weight"), F.col("m") * BLOCK))).drop("weight")

    # groups that can hold a pair; of groups with the same sets, the one of the first run
    rows = blocked(leaves, "m", BLOCK, "node", "leaf").join(nodes.select("node", "mins"), "node").select("task", "side", "r", "node", "mins")
    parts = parts_for(spark, amount, 20_000)
    grouped = rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(_parted(size, jaccard * 0.6), "task long, side int, r int, node long")
    grouped = work.keep(grouped, "groups")
    same = grouped.groupBy("task").agg(F.count("*").alias("m"), F.sum(F.xxhash64("node", "side").cast("decimal(20,0)")).alias("sig"), F.min("r").alias("r"))
    chosen = same.groupBy("m", "sig").agg(F.min(F.struct("r", "task")).alias("t")).select("t.task")
    parted, grouped = grouped, work.keep(grouped.join(chosen, "task"), "chosen")

    # whole sets of what is left
    path = leaves.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("r", "leaf"))).alias("at"))
    own = [F.coalesce(F.col("at")[F.lit(i)], F.xxhash64("node", F.lit(i))) for i in range(paths)]
    wanted = grouped.select("node").distinct().join(nodes.select("node", "rep.*", "mult"), "node").join(path, "node").select("node", "k1", "k2", "mult", F.array(*own).alias("leaves"))
    wanted = work.keep(wanted, "wanted")
    texts = d.select("k1", "k2", "text").join(wanted.select("k1", "k2", "node"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    sets = work.keep(texts.select("node", "text").mapInArrow(_sets(k), "node long, body binary"), "sets")
    rows = grouped.join(sets.join(wanted.select("node", "mult", "leaves"), "node"), "node").select("task", "side", "r", "node", "mult", "leaves", "body")
    found = rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(_verified(jaccard), "node long, root long, links long")
    found = work.keep(found, "found")

    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), work)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = nodes.select("node", "mult", "least", "rep").join(links, "node", "left").join(comp, "node", "left")
    of = of.select("node", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("comp", "node").alias("comp"), "least", "rep")
    # the least id stands for a class; of null ids alone, the least key
    top = of.groupBy("comp").agg(F.min("least").alias("class_id"), F.min(F.struct(F.coalesce("least", F.lit(2**63 - 1)).alias("least"), "rep")).alias("f"))
    of = of.join(top.select("comp", "class_id", F.struct("f.rep.k1", "f.rep.k2").alias("first")), "comp").select("node", "n_links", "class_id", "first")
    of = work.keep(of, "classes")
    work.drop(*levels, parted, grouped, wanted, sets, found, nodes)
    out = every.where("n > 0").select("k1", "k2", "doc_id", "node").join(of, "node").drop("node")
    alone = every.where("n = 0").select("k1", "k2", "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.struct("k1", "k2").alias("first"))
    return out.unionByName(alone)


def report(docs: DataFrame, k: int = WORDS, jaccard: float = JACCARD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least doc_id of the documents that links reach), n_links (documents linked directly)."""
    return classes(docs, k, jaccard, recall).select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"))


def one_each(docs: DataFrame, k: int = WORDS, jaccard: float = JACCARD, recall: float = RECALL) -> DataFrame:
    """docs with one document of each class, that with the least doc_id; every text without words stays."""
    k1, k2, lot = unused(docs, "k1", "k2", "lot")
    named = docs.withColumns({k1: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), k2: F.xxhash64("text")})
    c = classes(docs, k, jaccard, recall)
    gone = c.where(~F.struct("k1", "k2").eqNullSafe(F.col("first"))).select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    left = named.join(gone, [k1, k2], "left_anti")
    # rows that repeat id and text are copies too; which stays is decided by a hash of all columns
    blank = F.coalesce(F.col("text"), F.lit("")).rlike(r"^[ \t\n\x0b\f\r]*$")
    cols = [f"`{c}`" for c in docs.columns]
    one = left.where(~blank).withColumn(lot, row_lot(docs)).groupBy(k1, k2).agg(*[F.min_by(c, lot).alias(c.strip("`")) for c in cols])
    return one.select(*cols).unionByName(left.where(blank).select(*cols))

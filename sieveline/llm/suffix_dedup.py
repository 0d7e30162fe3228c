"""Suffix-array dedup by a depth-limited radix sort.

Suffixes are ordered only through their first `window` bytes, by passes from the most significant digit on: a pass refines
the groups of the last one by the next digit of fixed width from the front of the suffix, and drops every group of one.
Suffixes still together at full depth are exactly the repeated windows. What makes this run on a cluster:

- Sampled suffixes first. The suffixes that start at content-defined anchors (see _repeats: the 100-gram of least hash in a
  window, 100 bytes being a digit) stand for all those whose window holds them: a run of up to 301 neighbouring suffixes is one
  row. Runs that agree in all their bytes become one row with a count. The rest are sorted from the anchor on: the first digit
  is the anchor, then come the next 100 bytes, and the next, as far as the run's windows reach.
- Induced suffixes then. Where equal runs can't be told by the anchor's suffix alone, the run is taken apart into blocks of 48,
  of 8 and of one suffix. A block is sorted by the suffix at its last place, from its front through all that its suffixes
  share, in two digits; a block that agrees in all its bytes with another is settled, one without a partner dropped, the
  others taken apart further. For one suffix the second digit reaches full depth.
- A digit's order is that of its 64-bit fingerprint, so the groups of a pass are sorted by digits; the members of a group are
  ordered by (doc_id, fingerprint of the text, place), and the first of them stands for it. Groups are counted with
  map-side combining and never meet in one task.

Defined results: a null or empty text has no bytes; a text under `window` bytes keeps all; repeated rows are copies of
each other; equal and null ids are legal; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import BLOCK_SCHEMA, SEGMENT_SCHEMA, byte_units, offsets_of, row_blocks, segments, with_spans
from ._spark import Work, keyed
from ._units import BYTE_VALUE, U, Prefix, groups, in_slices, mix, raw, signed, tidy

WINDOW = 400
#: Digits a window; numbers of suffixes a row once runs are taken apart, each a divisor of the one before.
DIGITS = 4
BLOCKS = (48, 8, 1)
DIGIT_SCHEMA = "k1 long, k2 long, seg long, mult int, o1 int, o2 int, at long, n int, front long, core long, cover long"


def refine(rows: DataFrame, digit: str, least: int = 2, count: str = "1") -> DataFrame:
    """One pass: rows whose group by this digit, a fingerprint of all bytes through it, has `least` members or more."""
    met = rows.where(F.col(digit).isNotNull()).groupBy(digit).agg(F.sum(F.expr(count)).alias("peers")).where(f"peers >= {least}")
    return rows.join(met.select(digit), digit, "left_semi")


def sampled(runs: DataFrame, window: int, digit: int, work: Work) -> DataFrame:
    """Runs of suffixes, one for each content, that still share their anchor's suffix with others after all passes.

    A run is judged through the depth that all its windows have from the anchor on (window - ohi); beyond it stays, as a
    partner for those that go deeper."""
    left = work.keep(refine(runs, "core"), f"digit{digit}")
    for depth in range(2 * digit, window, digit):
        met = left.where(f"d{depth} is not null").groupBy(f"d{depth}").agg(F.count("*").alias("peers")).where("peers > 1").select(f"d{depth}", F.lit(True).alias("met"))
        now = work.keep(left.join(met, f"d{depth}", "left").where(f"met or {window} - ohi < {depth}").drop("met"), f"digit{depth}")
        work.drop(left)
        left = now
    return left


def _digits(length: int, size: int) -> Callable:
    """Blocks of `size` suffixes of each segment, by the suffix at the block's last place: front is its first digit, core all
    that the block's suffixes share, cover all their bytes."""
    deep = length - size + 1
    half = (deep + 1) // 2

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = raw(batch.column("body"))
            col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "seg", "ohi", "mult")}
            for lo, hi in groups(offs):
                prefix = Prefix(BYTE_VALUE[data[offs[lo] : offs[hi]]])
                seg, b, o1, o2 = offsets_of(batch, lo, hi, size)
                ohi = col["ohi"][lo + seg]
                anchor = offs[lo + seg] - offs[lo] + ohi
                place, salt = anchor - b * size, b.astype(np.uint64) + U(1)
                front = mix(prefix.hash(place, place + half) ^ salt)
                core = mix(prefix.hash(place, place + deep) ^ salt)
                cover = mix(prefix.hash(anchor - o2, anchor - o1 + length) ^ (o1 * 65536 + o2).astype(np.uint64))
                own = [col[c][lo + seg] for c in ("k1", "k2", "seg", "mult")]
                rest = [o1.astype(np.int32), o2.astype(np.int32), col["seg"][lo + seg] + ohi - o2, (o2 - o1 + 1).astype(np.int32), signed(front), signed(core), signed(cover)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*own, *rest)], names=["k1", "k2", "seg", "mult", "o1", "o2", "at", "n", "front", "core", "cover"])

    return tidy(f)


def spans(docs: DataFrame, window: int = WINDOW, work: Work | None = None) -> DataFrame:
    """(k1, k2, spans): for every text with repeated windows where runs of them start and how many they are, as
    array<struct<at, n>>; the keys are those of _spark.keyed."""
    work = work or Work(docs.sparkSession, "suffix")
    digit = max(1, window // DIGITS)
    depths = list(range(2 * digit, window, digit))
    d = keyed(docs, "doc_id", "text").drop("doc_id")
    schema = BLOCK_SCHEMA + "".join(f", d{x} long" for x in depths)
    found = work.keep(d.mapInArrow(row_blocks(byte_units, window, digit, depths), schema), "runs")
    same = found.groupBy("core", "cover").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2", "at", "n", "ohi", *(f"d{x}" for x in depths))).alias("rep"))
    same = work.keep(same.select("core", "cover", "m", "rep.*"), "distinct")
    settled = [work.keep(found.join(same.where("m > 1").select("core", "cover"), ["core", "cover"]).select("k1", "k2", "at", "n"), "settled")]
    work.drop(found)
    left = sampled(same, window, digit, work)
    opened = left.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n", "ohi", F.least("m", F.lit(2)).cast("int").alias("mult"))).alias("open"))
    bodies = d.join(opened, ["k1", "k2"]).mapInArrow(segments(False, window), SEGMENT_SCHEMA)
    segs = work.keep(bodies.withColumn("todo", F.array(F.struct((F.col("ohi") - F.col("n") + 1).alias("b1"), F.col("ohi").alias("b2")))), "segments")
    work.drop(same, left)
    for size in [x for x in BLOCKS if 2 * x <= window or x == 1]:
        rows = work.keep(segs.mapInArrow(_digits(window, size), DIGIT_SCHEMA), f"suffixes{size}")
        if size == 1:  # core and cover are the window itself
            last = refine(work.keep(refine(rows, "front", count="mult"), "front1"), "cover", count="mult")
            settled.append(work.keep(last.where("mult = 1").select("k1", "k2", "at", "n"), "settled1"))
            work.drop(rows, segs)
            break
        same = work.keep(rows.groupBy("front", "core", "cover").agg(F.sum("mult").alias("m"), F.min(F.struct("k1", "k2", "seg", "o1", "o2")).alias("rep")), f"distinct{size}")
        # blocks with mult 2 stand for runs that are settled whole
        settled.append(work.keep(rows.where("mult = 1").join(same.where("m > 1").select("core", "cover"), ["core", "cover"]).select("k1", "k2", "at", "n"), f"settled{size}"))
        left = refine(work.keep(refine(same, "front"), f"front{size}"), "core")
        todo = left.select("rep.*").groupBy("k1", "k2", "seg").agg(F.collect_list(F.struct(F.col("o1").alias("b1"), F.col("o2").alias("b2"))).alias("todo"))
        kept = work.keep(segs.drop("todo").join(todo, ["k1", "k2", "seg"]), f"segments{size}")
        work.drop(rows, segs, same)
        segs = kept
    every = settled[0]
    for s in settled[1:]:
        every = every.unionByName(s)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "n")).alias("spans"))  # a set: repeated rows name the same runs


def covered(n: int, spans: list[dict] | None, length: int) -> np.ndarray | None:
    """Which of n bytes the windows cover; None for none."""
    if not spans:
        return None
    edge = np.zeros(n + 1, np.int32)
    start = np.fromiter((s["at"] for s in spans), np.int64, len(spans))
    end = start + np.fromiter((s["n"] for s in spans), np.int64, len(spans)) - 1 + length
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(window: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            found = batch.column("spans")
            size, gone, runs, sha = [], [], [], []
            for i in range(len(batch)):
                body = texts[i].as_py() or b""
                mask = covered(len(body), found[i].as_py(), window)
                removed = pieces = 0
                size.append(len(body))
                if mask is not None:
                    removed = int(mask.sum())
                    pieces = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    body = np.frombuffer(body, np.uint8)[~mask].tobytes()
                gone.append(removed)
                runs.append(pieces)
                sha.append(hashlib.sha256(body).hexdigest())
            cols = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, gone, runs)), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return tidy(f)


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 for every row: each byte covered by a
    string of `window` bytes that also starts anywhere else is removed; judged on the input, overlaps included."""
    both = with_spans(docs, spans(docs, window))
    return both.mapInArrow(_cut(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

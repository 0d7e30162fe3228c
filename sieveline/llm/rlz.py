"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the whole corpus, cut into content-defined blocks of words (see _repeats). Its index holds for every block
how often it occurs and its first and last place (document, word), a fixed size whatever the block's frequency, counted with
map-side combining. Each document is then parsed greedily from left to right: at a block that the index knows from elsewhere a
factor starts at that one of its two places which can be followed farthest, and takes in block after block while the index has
the next one at the next words of the same source. The result is a list of factors (start, length, source document, source
start), each a copy of words elsewhere. With more than two places of a block a third could be followed farther: then a longer
factor is told as two, of the same words.

Blocks are cut by the words around them, so that a copied passage's first and last words lie in blocks that the other copies
don't have whole. There, at the boundaries of factors, and for passages shorter than a block, the parts of a block are looked
up in an index of such parts, four windows and then one window wide, among the blocks of the same anchor. So no window of
`window` words that starts elsewhere is lost, and factors of at least `window` words are exactly the duplicate spans.

Defined results: a null text has no words; an empty one neither; repeated rows are copies of each other and lose all
windows they share (a copy's source may be the same place of the row that it repeats); equal and null ids are legal; an empty
table gives an empty result; columns beside doc_id and text are ignored by the factors and kept by `remove`, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ._repeats import BLOCK_SCHEMA, SEGMENT_SCHEMA, offsets_of, row_blocks, segments, with_spans, word_units
from ._spark import MIN_LONG, Work, keyed
from ._units import U, Prefix, groups, in_slices, mix, raw, signed, tidy

WINDOW = 35
ANCHOR = 8
PARTS = (4, 1)
PART_SCHEMA = "k1 long, k2 long, seg long, ohi int, mult int, o1 int, o2 int, at long, n int, core long, cover long"

Place = tuple[int, int, int]


def parse(at: Sequence[int], n: Sequence[int], places: Sequence[tuple[Place, ...]], key: tuple[int, int], window: int) -> list[tuple[int, int, Place]]:
    """The greedy parse of one document: factors (start, length, source) in words.

    at, n: known stretches of n windows from word `at` on, rising; places: where the index has each of them, as (k1, k2,
    word), this document's own place perhaps among them; key: this document."""
    # a source is followed along its diagonal, its place less ours
    ways = []
    for a, known in zip(at, places, strict=True):
        other = [p for p in known if p != (*key, a)] or list(known)
        ways.append({(k1, k2, s - a) for k1, k2, s in other})
    out, i = [], 0
    while i < len(at):
        best, source = -1, (0, 0, 0)
        for way in sorted(ways[i]):
            j = i
            while j + 1 < len(at) and at[j + 1] == at[j] + n[j] and way in ways[j + 1]:
                j += 1
            if j > best:
                best, source = j, way
        out.append((at[i], at[best] + n[best] - 1 + window - at[i], (source[0], source[1], source[2] + at[i])))
        i = best + 1
    return out


def _index(rows: DataFrame, count: Column, *more: str) -> DataFrame:
    """Blocks that occur more than once or share their anchor with other blocks: m occurrences, nd other blocks of the
    anchor, the first and the last place; `more` columns of the first."""
    a = rows.groupBy("core", "cover").agg(count.alias("m"), F.min(F.struct("k1", "k2", "at", *more)).alias("first"), F.max(F.struct("k1", "k2", "at")).alias("last"))
    nd = a.groupBy("core").agg(F.count("*").alias("nd")).where("nd > 1")
    return a.join(nd, "core", "left").where("m > 1 or nd is not null")


def _known(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose block the index has from elsewhere, with its places there."""
    places = index.where("m > 1").select("core", "cover", F.struct("first.k1", "first.k2", "first.at").alias("first"), "last")
    return rows.join(places, ["core", "cover"]).select("k1", "k2", F.struct("at", "n", "first", "last").alias("piece"))


def _parts(length: int, size: int) -> Callable:
    """Parts of `size` windows of each segment: core is what all windows of the part share, cover all their words."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = raw(batch.column("body"))
            col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "seg", "ohi", "mult")}
            for lo, hi in groups(offs):
                values, first = word_units(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                prefix = Prefix(values)
                seg, b, o1, o2 = offsets_of(batch, lo, hi, size)
                ohi = col["ohi"][lo + seg]
                anchor = first[seg] + ohi
                core = mix(prefix.hash(anchor - b * size, anchor - b * size - size + 1 + length) ^ (b.astype(np.uint64) + U(1)))
                cover = mix(prefix.hash(anchor - o2, anchor - o1 + length) ^ (o1 * 65536 + o2).astype(np.uint64))
                own = [col[c][lo + seg] for c in ("k1", "k2", "seg", "ohi", "mult")]
                place = [o1.astype(np.int32), o2.astype(np.int32), col["seg"][lo + seg] + ohi - o2, (o2 - o1 + 1).astype(np.int32), signed(core), signed(cover)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*own, *place)], names=["k1", "k2", "seg", "ohi", "mult", "o1", "o2", "at", "n", "core", "cover"])

    return tidy(f)


def pieces(docs: DataFrame, window: int = WINDOW, work: Work | None = None) -> DataFrame:
    """(k1, k2, spans): for every text with words known from elsewhere its known stretches, as an array of
    struct<at, n, first, last>; the keys are those of _spark.keyed."""
    work = work or Work(docs.sparkSession, "rlz")
    d = keyed(docs, "doc_id", "text").drop("doc_id")
    blocks = work.keep(d.mapInArrow(row_blocks(word_units, window, min(ANCHOR, window)), BLOCK_SCHEMA), "blocks")
    index = work.keep(_index(blocks, F.count("*"), "n", "ohi"), "index")
    known = [work.keep(_known(blocks, index), "known")]
    opened = index.where("nd is not null").select("first.*", F.least("m", F.lit(2)).cast("int").alias("mult"))
    opened = opened.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n", "ohi", "mult")).alias("open"))
    # one block of each cover is opened; rows that agree in id and text share a key, and one of them is as good as another
    bodies = d.join(opened, ["k1", "k2"]).mapInArrow(segments(True, window), SEGMENT_SCHEMA)
    segs = work.keep(bodies.withColumn("todo", F.array(F.struct((F.col("ohi") - F.col("n") + 1).alias("b1"), F.col("ohi").alias("b2")))), "segments")
    work.drop(blocks, index)
    for size in PARTS:
        rows = work.keep(segs.mapInArrow(_parts(window, size), PART_SCHEMA), f"parts{size}")
        index = work.keep(_index(rows, F.sum("mult"), "seg", "o1", "o2"), f"index{size}")
        known.append(work.keep(_known(rows.where("mult = 1"), index), f"known{size}"))  # twofold covers are known whole
        if size > 1:
            again = index.where("nd is not null").select("first.*").groupBy("k1", "k2", "seg").agg(F.collect_list(F.struct(F.col("o1").alias("b1"), F.col("o2").alias("b2"))).alias("todo"))
            kept = work.keep(segs.drop("todo").join(again, ["k1", "k2", "seg"]), f"segments{size}")
            work.drop(rows, segs, index)
            segs = kept
        else:
            work.drop(rows, segs, index)
    every = known[0]
    for k in known[1:]:
        every = every.unionByName(k)
    return every.groupBy("k1", "k2").agg(F.collect_set("piece").alias("spans"))  # a set: repeated rows name the same stretches


def _factors(batch: pa.RecordBatch, window: int) -> Iterator[list[tuple[int, int, Place]]]:
    """The parse of every row of (k1, k2, spans)."""
    spans = batch.column("spans")
    flat = spans.flatten()
    offs = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    at, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
    order = np.lexsort((at, np.repeat(np.arange(len(batch)), np.diff(offs))))
    at, n = at[order].tolist(), n[order].tolist()
    first, last = ([flat.field(p).field(c).to_numpy(zero_copy_only=False)[order].tolist() for c in ("k1", "k2", "at")] for p in ("first", "last"))
    keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
    for i, key in enumerate(keys):
        a, b = int(offs[i]), int(offs[i + 1])
        yield parse(at[a:b], n[a:b], list(zip(zip(*(x[a:b] for x in first), strict=True), zip(*(x[a:b] for x in last), strict=True), strict=True)), key, window) if a < b else []


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, source_id, source_start: the factors of every document, in words from 0 on. Rows that agree
    in id and text are parsed once."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k1, start, length, source[0], source[2]) for k1, found in zip(batch.column("k1").to_pylist(), _factors(batch, window), strict=True) for start, length, source in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "length", "source_id", "source_start"])

    out = pieces(docs, window).mapInArrow(f, "doc_id long, start long, length long, source_id long, source_start long")
    return out.withColumns({c: F.when(F.col(c) != MIN_LONG, F.col(c)) for c in ("doc_id", "source_id")})


def _parsed(window: int, digest: bool):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            n_words, n_removed, kept = [], [], []
            for i, found in enumerate(_factors(batch, window)):
                body = texts[i].as_py()
                parts = (body or b"").split()
                n = len(parts)
                if found:
                    keep = np.ones(n, bool)
                    for a, length, _ in found:
                        keep[a : a + length] = False
                    parts = [parts[j] for j in np.flatnonzero(keep)]
                n_words.append(n)
                n_removed.append(n - len(parts))
                if digest:
                    kept.append(hashlib.sha256(b" ".join(parts)).hexdigest())
                else:
                    kept.append((b" ".join(parts) if found else body).decode("utf-8", "replace") if body is not None else None)
            cols = [batch.column("k1"), batch.column("k2"), batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["k1", "k2", "doc_id", "n_words", "n_removed", "kept"])

    return tidy(f)


_PARSED = "k1 long, k2 long, doc_id long, n_words long, n_removed long, kept string"


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row: each word covered by a window of `window` words whose
    sequence also starts anywhere else, in this document or another, is removed; judged on the input."""
    out = with_spans(docs, pieces(docs, window)).mapInArrow(_parsed(window, True), _PARSED)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the repeated words taken out of text; n_chars, if there, follows. A text without repeats stays as it
    is, white space included; another keeps its words joined by one space. No row goes, none comes."""
    k1, k2, text = unused(docs, "k1", "k2", "new_text")
    d = docs.withColumns({k1: F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_LONG)), k2: F.xxhash64("text")})
    found = keyed(docs, "doc_id", "text").join(pieces(docs, window), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    new = found.select("k1", "k2", "doc_id", "text", "spans").mapInArrow(_parsed(window, False), _PARSED)
    new = new.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("kept").alias(text))
    changed = F.col(text).isNotNull()
    out = d.join(new, [k1, k2], "left").withColumn("text", F.when(changed, F.col(text)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])

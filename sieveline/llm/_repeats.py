"""Content-defined blocks of texts: where they are cut, what covers them, and the stretches of texts that need a closer look.

Every window of L units (words or bytes) has an anchor, the k-gram of least hash in it (leftmost on ties). Neighbouring
windows with one anchor form a block. Equal windows have equal anchors at equal offsets, so only blocks of one anchor need
comparing, and equal passages are cut into equal blocks wherever they stand. About 2 / (L - k + 2) blocks a unit leave a map
task as narrow rows, without text. Keys are 64-bit fingerprints; blocks count as equal if those of anchor and cover agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._spark import keyed
from ._units import BYTE_VALUE, PIECE, U, Prefix, groups, mix, raw, signed, sliding_min, spread, tidy, words

POS = U((1 << 24) - 1)

#: at: first window's start; n: windows; ohi: the anchor's offset in the first window; core: the anchor; cover: all units.
BLOCK_SCHEMA = "k1 long, k2 long, at long, n int, ohi int, core long, cover long"
#: units of rows: (values, first unit of each row)
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUE[data], offs


def word_units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return words(data, offs)


def cut(values: np.ndarray, prefix: Prefix, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Blocks of concatenated rows; ends: each row's end. (start, windows, anchor's place, anchor's gram, cover)."""
    none = np.zeros(0, np.int64)
    n = len(values)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = spread(values, k)
    least = sliding_min((grams & ~POS) | np.arange(len(grams), dtype=np.uint64), length - k + 1)
    at = np.arange(n - length + 1)
    valid = ends[np.searchsorted(ends, at, "right")] >= at + length
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    start = np.flatnonzero(new)
    stop = np.append(np.flatnonzero(new | ~valid), len(at))
    end = stop[np.searchsorted(stop, start, "right")]
    anchor = (least[start] & POS).astype(np.int64)
    count = end - start
    cover = mix(prefix.hash(start, end - 1 + length) ^ ((anchor - start) * 65536 + count).astype(np.uint64))
    return start, count, anchor, prefix.hash(anchor, anchor + k), cover


def row_blocks(units: Units, length: int, k: int, depths: Sequence[int] = ()) -> Callable:
    """The blocks of every text. For each depth a column more: the fingerprint of so many units from the anchor on, null
    where the windows of the block don't reach so far."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = raw(batch.column("text"))
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            for lo, hi in groups(offs):
                values, first = units(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                step = max(4 * length, 2 * PIECE)
                for a in range(0, max(1, len(values) - length + 1), step):  # more than one step only for a very long text
                    part = values[a : a + step + length - 1]
                    prefix = Prefix(part)
                    start, n, anchor, core, cover = cut(part, prefix, np.clip(first[1:] - a, 0, len(part)), length, k)
                    if not len(start):
                        continue
                    row = np.searchsorted(first, start + a, "right") - 1
                    cols = [k1[lo + row], k2[lo + row], start + a - first[row], n.astype(np.int32), (anchor - start).astype(np.int32), signed(core), signed(cover)]
                    arrays = [pa.array(x) for x in cols]
                    for depth in depths:
                        beyond = anchor + depth > start + n - 1 + length
                        arrays.append(pa.array(signed(prefix.hash(anchor, np.where(beyond, anchor, anchor + depth))), mask=beyond))
                    yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "at", "n", "ohi", "core", "cover", *(f"d{depth}" for depth in depths)])

    return tidy(f)


SEGMENT_SCHEMA = "k1 long, k2 long, seg long, n int, ohi int, mult int, body binary"


def segments(of_words: bool, length: int) -> Callable:
    """Cuts the stretches that open blocks cover out of their texts; open: array<struct<at, n, ohi, mult>>."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            out: list[list] = [[] for _ in range(7)]
            size = 0
            for i in range(len(batch)):
                body = texts[i].as_py() or b""
                if of_words:
                    parts = body.split()
                for s in batch.column("open")[i].as_py():
                    a, b = s["at"], s["at"] + s["n"] - 1 + length
                    piece = b" ".join(parts[a:b]) if of_words else body[a:b]
                    size += len(piece)
                    for o, x in zip(out, (batch.column("k1")[i].as_py(), batch.column("k2")[i].as_py(), a, s["n"], s["ohi"], s["mult"], piece), strict=True):
                        o.append(x)
                    if size > 16 * PIECE:
                        yield pack(out)
                        out, size = [[] for _ in range(7)], 0
            if out[0]:
                yield pack(out)

    def pack(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["k1", "k2", "seg", "n", "ohi", "mult", "body"])

    return tidy(f)


def offsets_of(batch: pa.RecordBatch, lo: int, hi: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts of `size` offsets that segments lo .. hi have to do: (segment, number of the part, first, last offset).

    A segment's todo holds ranges of offsets [b1, b2]; each is cut into the parts that it meets."""
    part = batch.column("todo").slice(lo, hi - lo)
    seg = np.repeat(np.arange(hi - lo), np.diff(part.offsets.to_numpy()))
    pair = part.flatten()
    b1, b2 = (pair.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (0, 1))
    lo_b, hi_b = b1 // size, b2 // size
    times = hi_b - lo_b + 1
    which = np.repeat(np.arange(len(seg)), times)
    b = lo_b[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    return seg[which], b, np.maximum(b * size, b1[which]), np.minimum(b * size + size - 1, b2[which])


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text, spans; every row of docs stays."""
    return keyed(docs, "doc_id", "text").join(spans, ["k1", "k2"], "left").select("k1", "k2", "doc_id", "text", "spans")

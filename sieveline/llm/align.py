"""Cross-tokenizer alignment by id-striped dense count matrices.

Two tokenizers read one text: A (byte-level, of a tokenizers file) the text with a blank before it, B (of a sentencepiece model)
the text, before which it puts a blank itself. Tokens of both are byte ranges of the same string. Where a token of A and one of B
end together the text is cut into groups; an A token and a B token whose ranges overlap are a link.

A text is cut before each blank that follows a sign other than white space. Neither tokenizer has tokens across such a place (for
B this is looked up in its pieces; a model that has some is given whole texts), so tokens, groups and links of a text are those
of its units, one after the other, and a unit is worked out once for as long as a worker remembers it.

Counts and scores are exact over all documents:

- Links. Documents are packed into chunks of about CHUNK bytes. A chunk leaves one row for each stripe of B ids (id modulo
  STRIPES): its distinct pairs with counts, and which document has which of them how often, sorted, as differences, compressed.
- Matrices. Pairs are dealt by stripe. A task streams them into a dense block, one row for each B id of the stripe and one
  column for each A id, by np.add.at; the largest of a row is the best count of that B id. From GROUP chunks on, blocks of GROUP
  chunks are added up first and then the blocks, so that no task reads more than GROUP rows of a stripe at a time.
- Scores. The counts of a stripe meet the links of the stripe, in as many parts as there are groups of chunks, and leave each
  document's links with a best count and its sum of counts, a row a chunk and stripe; these are added up by chunk.

What travels is compressed and bounded by chunk or by vocabulary; no id's links are ever gathered.

Defined results: texts that are null or empty, or that either tokenizer doesn't give back byte by byte, have no tokens, zeros
and an empty digest; special tokens' strings are plain text; repeated rows and null ids stay rows of their own; an empty table
gives an empty result; other columns are ignored. A very long text ends its chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import whole_groups
from ._spark import Work, parts_for
from ._units import in_slices, tidy

CHUNK, STRIPES, GROUP = 4 << 20, 128, 512
#: A worker that remembers more units than this at the end of a chunk starts anew.
REMEMBER = 400_000
#: Units that are read as one text.
TOGETHER = 256

BLANK, CUT, CLOSE = "▁", re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")

DOC_SCHEMA = "chunk long, stripe int, docs binary, pairs binary, links binary"
SCORE_SCHEMA = "chunk long, stripe int, scores binary"
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable bytes for themselves, the others for the signs
    from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def aligned(a: list[int], b: list[int], a_sizes: list[int], b_sizes: list[int]) -> tuple[list[int], list[str]]:
    """(overlapping tokens as b << 32 | a, groups as text) of two sequences of ids over the same bytes, with their sizes."""
    pairs, groups = [], []
    i = j = i0 = j0 = 0
    gap = 0  # how far A's open token ends beyond B's
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        gap = a_sizes[i] - b_sizes[j]
        if not gap:  # one token each, as most are
            pairs.append(y << 32 | x)
            groups.append(f"{x}|{y}")
            i += 1
            j += 1
            continue
        i0, j0 = i, j
        while gap:
            pairs.append(b[j] << 32 | a[i])
            if gap < 0:
                i += 1
                gap += a_sizes[i]
            else:
                j += 1
                gap -= b_sizes[j]
        pairs.append(b[j] << 32 | a[i])
        i += 1
        j += 1
        groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
    return pairs, groups


class Aligner:
    """Units of texts, worked out by both tokenizers and remembered."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        of = byte_alphabet()
        self.a_bytes = {i: bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.in_units = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.head = len(self.b.encode("a"))
        self.sizes = (max(self.a_bytes) + 1, len(pieces))
        self.a_size, self.b_size = np.zeros(self.sizes[0], np.int64), np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        # an id as text with what may follow it: A's , or |, B's , or ; or the unit's end
        self.said = [b"%d%s" % (i, x) for i in range(self.sizes[0]) for x in (b",", b"|")] + [b"%d%s" % (i, x) for i in range(self.sizes[1]) for x in (b",", b";", b"\n")]

        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.text: list[bytes] = []
        self.first, self.pairs, self.figures = array("q", [0]), array("q"), array("i")
        self.bad: set[int] = set()

    def units(self, text: str) -> list[str]:
        """The units of a text, each without the blank that it starts with."""
        if not self.in_units:
            return [text]
        return text.split(" ") if not CLOSE.search(" " + text) else [u[1:] for u in CUT.split(" " + text)]

    def _learn(self, units: list[str]) -> None:
        """Units that may follow each other are read TOGETHER at a time; where that doesn't give their bytes back, one by one."""
        single = units
        if self.in_units:
            single, plain = [], []
            for u in units:
                (single if not u or u[-1].isspace() else plain).append(u)
            for lo in range(0, len(plain), TOGETHER):
                some = plain[lo : lo + TOGETHER]
                if not self._together(some):
                    single.extend(some)
        if single:
            self._one_by_one(single)

    def _together(self, units: list[str]) -> bool:
        """Ends of tokens are compared as arrays: a link for each stretch between neighbouring ends, a group for each common end."""
        text = " " + " ".join(units)
        x, y = self.a.encode(text, add_special_tokens=False).ids, self.b.encode("a" + text)[self.head :]
        own = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, x)) != own or b"".join(map(self.b_bytes.__getitem__, y)) != own:
            return False
        a, b = np.array(x, np.int64), np.array(y, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends, in_a, in_b = np.zeros((3, len(own) + 1), bool)
        ends[np.cumsum([len(u.encode()) + 1 for u in units])] = in_a[a_end] = in_b[b_end] = True
        both = in_a & in_b
        if not self.a_size[a].all() or not self.b_size[b].all() or (ends & ~both).any():
            return False
        unit, cut, group = np.flatnonzero(ends), np.flatnonzero(in_a | in_b), np.flatnonzero(both)
        per = [np.diff(np.searchsorted(at, unit, "right"), prepend=0) for at in (a_end, b_end, group, cut)]
        pairs = b[np.searchsorted(b_end, cut)] << 32 | a[np.searchsorted(a_end, cut)]
        # a group's A ids, then its B ids
        a_group, b_group = np.searchsorted(group, a_end), np.searchsorted(group, b_end)
        said = np.empty(len(a) + len(b), np.int64)
        said[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = 2 * a + both[a_end]
        said[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = 2 * self.sizes[0] + 3 * b + both[b_end] + ends[b_end]
        k = len(self.text)
        self.index.update(zip(units, range(k, k + len(units)), strict=True))
        self.text.extend(b"".join(map(self.said.__getitem__, said.tolist())).split(b"\n")[:-1])
        self.first.frombytes((self.first[-1] + np.cumsum(per[3])).astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.tobytes())
        self.figures.frombytes(np.stack(per, 1).astype(np.int32).tobytes())
        return True

    def _one_by_one(self, units: list[str]) -> None:
        """B reads a unit after an `a`, so that it stands as in the text."""
        a = [x.ids for x in self.a.encode_batch([" " + u for u in units], add_special_tokens=False)]
        b = [x[self.head :] for x in self.b.encode(["a " + u for u in units], num_threads=1)] if self.in_units else self.b.encode(units, num_threads=1)
        a_bytes, b_bytes, k = self.a_bytes, self.b_bytes, len(self.text)
        for unit, x, y in zip(units, a, b, strict=True):
            own, xs, ys = f" {unit}".encode(), [a_bytes[i] for i in x], [b_bytes[i] for i in y]
            self.index[unit] = k
            if b"".join(xs) != own or b"".join(ys) != own:
                self.bad.add(k)
                x = y = []
            pairs, groups = aligned(x, y, list(map(len, xs)), list(map(len, ys)))
            self.text.append(";".join(groups).encode())
            self.pairs.extend(pairs)
            self.first.append(len(self.pairs))
            self.figures.extend((len(x), len(y), len(groups), len(pairs)))
            k += 1

    def __call__(self, text: str) -> list[int]:
        """Places of a text's units; none where it isn't given back byte by byte. They hold until `forget`."""
        if not text:
            return []
        parts = self.units(text)
        if new := set(parts).difference(self.index):
            self._learn(list(new))
        at = list(map(self.index.__getitem__, parts))
        return at if self.bad.isdisjoint(at) else []


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _press(*columns: np.ndarray) -> bytes:
    """Columns of non-negative integers of one length, by planes of bytes, compressed."""
    wide = [max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1 for c in columns]
    planes = [np.ascontiguousarray(c, np.uint64).view(np.uint8).reshape(-1, 8)[:, :w].T.ravel() for c, w in zip(columns, wide, strict=True)]
    head = np.array([len(columns[0]), *wide], np.uint64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(p.tobytes() for p in planes))


def _unpress(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, *wide = raw[: 8 * (columns + 1)].copy().view(np.uint64).astype(int).tolist()
    at, out = 8 * (columns + 1), []
    for w in wide:
        c = np.zeros((n, 8), np.uint8)
        c[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(c.view(np.int64).ravel())
        at += n * w
    return out


class Chunk:
    """Documents until they are packed, and the units of each as places in what the aligner remembers."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sha: list[str] = []
        self.what: list[np.ndarray] = []
        self.often: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str, work: Aligner) -> None:
        units = work(text)
        what, often = np.unique(np.array(units, np.int64), return_counts=True)
        self.ids.append(doc_id)
        self.sha.append(hashlib.sha256(b";".join(map(work.text.__getitem__, units))).hexdigest() if units else "")
        self.what.append(what)
        self.often.append(often)
        self.size += len(text) + 8

    def rows(self, work: Aligner, stripes: int) -> pa.RecordBatch:
        """A row for the documents (stripe -1) and one for each stripe that they have links in."""
        chunk, n = uuid.uuid4().int >> 65, len(self.ids)
        what, often, who = np.concatenate(self.what), np.concatenate(self.often), np.repeat(np.arange(n), [len(x) for x in self.what])
        distinct, what = np.unique(what, return_inverse=True)
        own = np.frombuffer(work.figures, np.int32).reshape(-1, 4)[distinct].astype(np.int64) if len(distinct) else np.zeros((0, 4), np.int64)
        figures = np.zeros((n, 4), np.int64)
        np.add.at(figures, who, own[what] * often[:, None])
        known = np.array([i is not None for i in self.ids])
        doc_ids = np.array([i or 0 for i in self.ids], np.int64).view(np.uint64)
        head = _press(doc_ids, known, np.array([bool(s) for s in self.sha]), *figures.T)
        out = [(chunk, -1, len(head).to_bytes(8, "little") + head + "".join(self.sha).encode(), None, None)]
        times = own[what, 3]
        first = np.array(work.first)[distinct[what]] if len(distinct) else times
        at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        pair = np.array(work.pairs)[at] if len(at) else np.zeros(0, np.int64)
        row, col = pair >> 32, pair & 0xFFFFFFFF
        # stripe, document, row of the block, column: 8, 24, 12 and 20 bits at most
        code = (row % stripes).astype(np.uint64) << np.uint64(56) | np.repeat(who, times).astype(np.uint64) << np.uint64(32) | ((row // stripes) << 20 | col).astype(np.uint64)
        order = np.argsort(code)
        code, weight = code[order], np.repeat(often, times)[order]
        start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        code, weight = code[start], np.add.reduceat(weight, start) if len(start) else weight
        edge = np.searchsorted(code >> np.uint64(56), np.arange(stripes + 1, dtype=np.uint64))
        for s, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            if lo == hi:
                continue
            pair, doc, w = (code[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.int64), (code[lo:hi] >> np.uint64(32) & np.uint64(0xFFFFFF)).astype(np.int64), weight[lo:hi]
            distinct, which = np.unique(pair, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, which, w)
            out.append((chunk, s, None, _press(np.diff(distinct, prepend=0), total), _press(np.diff(doc, prepend=0), which, w)))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DOC_SCHEMA.split(", ")])


def _packed(a_path: str, b_path: str, stripes: int, size: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        chunk = Chunk()
        for batch in in_slices(batches, "text"):
            texts = batch.column("text")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = texts[i].as_py() or ""
                chunk.add(doc_id, text, work)
                if chunk.size >= size:
                    yield chunk.rows(work, stripes)
                    chunk = Chunk()
                    if len(work.text) > REMEMBER:
                        work.forget()
        if chunk.ids:
            yield chunk.rows(work, stripes)

    return tidy(f)


def _added(shape: tuple[int, int]):
    """Pairs with counts, sorted by part, streamed into one dense block for each part: (part, pairs)."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part = np.zeros(shape, np.int64), None
        cells = block.ravel()  # a view

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(cells)
            row, col = np.divmod(at, shape[1])
            blob = _press(np.diff(row << 20 | col, prepend=0), cells[at], block.max(1)[row])
            cells[at] = 0
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([blob], pa.binary())], names=["part", "pairs"])

        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("pairs"), strict=True):
                if part is not None and p != part:
                    yield done()
                part = p
                gaps, n = _unpress(blob.as_py(), 2)
                pair = np.cumsum(gaps)
                np.add.at(cells, (pair >> 20) * shape[1] + (pair & 0xFFFFF), n)
        if part is not None:
            yield done()

    return tidy(f)


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks without their largest, as pairs to be added up again."""
    for batch in batches:
        blobs = [_press(*_unpress(x.as_py(), 3)[:2]) for x in batch.column("pairs")]
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(blobs, pa.binary())], names=["part", "pairs"])


def _scored(shape: tuple[int, int]):
    """The links of a part's chunks against the counts of its stripe, which come first (chunk -1)."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best, touched = np.zeros(shape, np.int64), np.zeros(shape[0], np.int64), np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for chunk, stripe, pairs, links in zip(batch.column("chunk").to_pylist(), batch.column("stripe").to_pylist(), batch.column("pairs"), batch.column("links"), strict=True):
                if chunk < 0:
                    gaps, n, largest = _unpress(pairs.as_py(), 3)
                    pair = np.cumsum(gaps)
                    count[touched] = 0
                    count[pair >> 20, pair & 0xFFFFF] = n
                    best[pair >> 20] = largest
                    touched = np.unique(pair >> 20)
                    continue
                pair = np.cumsum(_unpress(pairs.as_py(), 2)[0])
                gaps, which, w = _unpress(links.as_py(), 3)
                doc = np.cumsum(gaps)
                n = count[pair >> 20, pair & 0xFFFFF]
                hit = n == best[pair >> 20]
                start = np.flatnonzero(np.concatenate([[True], gaps[1:] > 0]))
                out.append((chunk, stripe, _press(np.diff(doc[start], prepend=0), np.add.reduceat(w * hit[which], start), np.add.reduceat(w * n[which], start))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "stripe", "scores"])

    return tidy(f)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk (stripe -1, first) with the sums of their scores."""
    for table, first in whole_groups(batches, "chunk"):
        docs, scores = table.column("docs").combine_chunks(), table.column("scores").combine_chunks()
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            blob = docs[lo].as_py()
            size = int.from_bytes(blob[:8], "little")
            ids, known, whole, *figures = _unpress(blob[8 : 8 + size], 3 + 4)
            n = len(ids)
            hits, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for k in range(lo + 1, hi):
                gaps, h, s = _unpress(scores[k].as_py(), 3)
                doc = np.cumsum(gaps)
                hits[doc] += h
                sums[doc] += s
            at = np.cumsum(whole) * 64
            sha = [blob[8 + size + e - 64 : 8 + size + e].decode() if w else "" for e, w in zip(at.tolist(), whole.tolist(), strict=True)]
            cols = [pa.array(ids, mask=known == 0), *(pa.array(x) for x in (*figures, hits, sums)), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in OUT.split(", ")])


def _blocks(docs: DataFrame, a_path: str, b_path: str, work: Work, chunk: int, stripes: int) -> tuple[DataFrame, DataFrame, int, int, tuple[int, int]]:
    """(rows of chunks, the counts of each stripe, how many chunks and groups of them, the shape of a block)."""
    spark = docs.sparkSession
    sizes = Aligner(a_path, b_path).sizes
    if stripes > 256 or -(-sizes[1] // stripes) > 4096 or sizes[0] > 1 << 20:
        raise ValueError(f"vocabularies of {sizes} don't fit {stripes} stripes")
    shape = (-(-sizes[1] // stripes), sizes[0])
    d = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    rows = work.keep(d.mapInArrow(_packed(a_path, b_path, stripes, chunk), DOC_SCHEMA), "chunks")
    n = rows.where("stripe = -1").count()
    groups = first = max(1, -(-n // GROUP))
    pairs = rows.where("stripe >= 0").select((F.pmod("chunk", F.lit(groups)) * stripes + F.col("stripe")).alias("part"), "pairs")

    def added(p: DataFrame, n: int) -> DataFrame:
        return p.repartition(parts_for(spark, n, 2), "part").sortWithinPartitions("part").mapInArrow(_added(shape), "part long, pairs binary")

    blocks = added(pairs, groups * stripes)
    while groups > 1:  # GROUP blocks become one, until a stripe has one
        groups_of = -(-groups // GROUP)
        blocks = work.keep(blocks, "blocks").mapInArrow(_thinned, "part long, pairs binary")
        blocks = added(blocks.withColumn("part", F.pmod(F.floor(F.col("part") / stripes), F.lit(groups_of)) * stripes + F.col("part") % stripes), groups_of * stripes)
        groups = groups_of
    return rows, work.keep(blocks, "counts"), n, first, shape


def pair_counts(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, stripes: int = STRIPES) -> DataFrame:
    """b_id, a_id, n (links corpus-wide), best (whether n is the b_id's highest): the alignment as a table."""
    _, counts, *_ = _blocks(docs, a_path, b_path, Work(docs.sparkSession, "align"), chunk, stripes)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("pairs"), strict=True):
                gaps, n, largest = _unpress(blob.as_py(), 3)
                pair = np.cumsum(gaps)
                yield pa.RecordBatch.from_arrays([pa.array((pair >> 20) * stripes + part), pa.array(pair & 0xFFFFF), pa.array(n), pa.array(n == largest)], names=["b_id", "a_id", "n", "best"])

    return counts.mapInArrow(f, "b_id long, a_id long, n long, best boolean")


def report(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, stripes: int = STRIPES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    work = Work(spark, "align")
    rows, counts, n, groups, shape = _blocks(docs, a_path, b_path, work, chunk, stripes)
    # a group of chunks and a stripe are one part; each has its own copy of the stripe's counts
    group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group")
    own = counts.select(F.lit(-1).cast("long").alias("chunk"), F.col("part").cast("int").alias("stripe"), "pairs", F.lit(None).cast("binary").alias("links"), group)
    links = rows.where("stripe >= 0").select("chunk", "stripe", "pairs", "links", F.pmod("chunk", F.lit(groups)).alias("group"))
    met = links.unionByName(own).repartition(parts_for(spark, groups * stripes, 2), "group", "stripe").sortWithinPartitions("group", "stripe", "chunk")
    scores = work.keep(met.select("chunk", "stripe", "pairs", "links").mapInArrow(_scored(shape), SCORE_SCHEMA), "scores")
    every = rows.where("stripe = -1").select("chunk", "stripe", "docs").unionByName(scores, allowMissingColumns=True)
    dealt = every.repartition(parts_for(spark, n, 2), "chunk").sortWithinPartitions("chunk", "stripe")
    return dealt.mapInArrow(_summed, OUT)

"""Language-model scoring by deleted interpolation.

A bigram model: P(w | u) = l2[b] c(u, w) / c(u) + l1[b] c(w) / N + l0[b] / (V + 1), where b is the bucket of log2 c(u) and the
weights of each bucket are learned by expectation-maximisation on held-out counts: one tenth of the training documents is
deleted from the counts (all counts less its own), and the weights are those that make it likeliest; then its counts go
back in. The held-out events enter EM as a histogram over (bucket, c(u, w) / c(u), c(w)), both in eighths of an octave, so
that what reaches the driver has a fixed bound and still counts every event.

Counting is exact and grows with the corpus. Documents are packed into chunks of about `CHUNK` bytes, written once. Each
chunk sends its distinct word and word-pair fingerprints with their counts, sorted, as differences and compressed, to
buckets by fingerprint (a pair that is everywhere comes once a chunk); a bucket adds up and answers each chunk with the
totals in the same order. Texts move once, compressed, to meet the answers. From `GROUP` chunks on the exchange has two levels, so
that a row stays some hundreds of fingerprints at any size: chunks send to `GROUP` coarse buckets, those of one group of chunks are
merged there and go on to fine buckets, and the totals come back the same way.

Tokens: A-Z lower-cased; words are runs of signs other than white space, and one end a text.

Defined results: a null or empty text has one token, the end; a null id is hashed as no document's and trains; repeated
rows are documents of their own; without training documents all counts are 0 and the model is uniform; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import whole_groups
from ._spark import Work, parts_for
from ._units import LOWER, mix, raw, tidy, words

CHUNK = 8 << 20
BUCKET_BYTES = 8 << 20
#: Chunks of a group, and coarse buckets; a group's counts must fit 32 bits.
GROUP = 512
CONTEXTS, STEPS, ROUNDS = 24, 8, 60
END, START = np.uint64(0x5F3759DF5F3759DF), np.uint64(0x0B4711D00DFEED01)
HELD, DELETED, TRAIN = 0, 1, 2

CHUNK_SCHEMA = "chunk long, kind int, bucket int, ids array<long>, flags array<int>, lens array<int>, blob binary"


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    gaps = np.diff(keys, prepend=np.uint64(0))
    planes = np.concatenate([gaps.view(np.uint8).reshape(-1, 8).T.ravel(), counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.ravel()])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(planes) // 12
    gaps = planes[: 8 * n].reshape(8, n).T.copy().view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64), planes[8 * n :].reshape(4, n).T.copy().view(np.uint32).ravel().astype(np.int64)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
    names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]

    def made(kind: int, parts: list) -> pa.RecordBatch:
        blob = zstandard.ZstdCompressor(level=3).compress(b"".join(x[2] for x in parts))
        row = (uuid.uuid4().int >> 65, kind, -1, [x[0] for x in parts], [x[1] for x in parts], [len(x[2]) for x in parts], blob)
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

    held: dict[int, list] = {0: [], 1: []}
    size = {0: 0, 1: 0}
    for batch in batches:
        data, offs = raw(batch.column("text"))
        for i, (doc_id, flag) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("flag").to_pylist(), strict=True)):
            kind = int(flag == DELETED)
            body = LOWER[data[offs[i] : offs[i + 1]]].tobytes()
            held[kind].append((doc_id, flag, body))
            size[kind] += len(body) + 8
            if size[kind] >= CHUNK:
                yield made(kind, held[kind])
                held[kind], size[kind] = [], 0
    for kind, parts in held.items():
        if parts:
            yield made(kind, parts)


class Tokens:
    """The tokens of a chunk: distinct words and pairs, sorted, and where each token has them."""

    def __init__(self, blob: bytes, lens: list[int], flags: list[int]):
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob) if sum(lens) else b"", np.uint8)
        values, first = words(data, np.concatenate([[0], np.cumsum(lens)]).astype(np.int64))
        n = np.diff(first) + 1  # with the end
        self.first = np.concatenate([[0], np.cumsum(n)])
        tok = np.empty(self.first[-1], np.uint64)
        last = np.zeros(len(tok), bool)
        last[self.first[1:] - 1] = True
        tok[last], tok[~last] = END, values
        before = np.empty_like(tok)
        before[1:] = tok[:-1]
        before[self.first[:-1]] = START
        self.train = np.repeat(np.array(flags) != HELD, n)
        # a word's own table holds the start too, as a context
        self.words, at = np.unique(np.concatenate([tok, before]), return_inverse=True)
        self.word, self.context = at[: len(tok)], at[len(tok) :]
        self.pairs, self.pair = np.unique(mix(mix(before) + tok), return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        w = np.bincount(self.word[self.train], minlength=len(self.words))
        w[self.words == START] = (self.train & (self.words[self.context] == START)).sum()
        return w, np.bincount(self.pair[self.train], minlength=len(self.pairs))


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits buckets begins in sorted keys."""
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(keys)])


def _counted(bits: int, word_bits: int):
    """Pair buckets come first, word buckets after them."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, kind, flags, lens, blob in zip(*(batch.column(c) for c in ("chunk", "kind", "flags", "lens", "blob")), strict=True):
                t = Tokens(blob.as_py(), lens.as_py(), flags.as_py())
                cw, cp = t.counts()
                rows: list[tuple[int, bytes]] = []
                for keys, counts, b, base in ((t.pairs, cp, bits, 0), (t.words, cw, word_bits, 1 << bits)):
                    e = _edges(keys, b)
                    rows += [(base + i, _pack(keys[lo:hi], counts[lo:hi])) for i, (lo, hi) in enumerate(zip(e[:-1], e[1:], strict=True)) if hi > lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk.as_py()] * len(rows), pa.int64()), pa.array([kind.as_py()] * len(rows), pa.int32()), pa.array([x for x, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                    names=["chunk", "kind", "bucket", "blob"],
                )

    return tidy(f)


def _answered(bits: int):
    """Totals of a bucket, for each chunk in the order of its keys: all and deleted. n, v, d: the bucket's training tokens,
    distinct ones and deleted ones, on one row of each word bucket."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, "bucket"):
            bucket, kind, chunk = (table.column(c).to_numpy() for c in ("bucket", "kind", "chunk"))
            blobs = table.column("blob").combine_chunks()
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                parts = [_unpack(blobs[i].as_py()) for i in range(a, b)]
                keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                counts = np.concatenate([c for _, c in parts])
                ends = np.cumsum([len(k) for k, _ in parts])
                deleted = np.repeat(kind[a:b] == DELETED, [len(k) for k, _ in parts])
                total = np.bincount(inverse, weights=counts, minlength=len(keys)).astype(np.int64)
                gone = np.bincount(inverse[deleted], weights=counts[deleted], minlength=len(keys)).astype(np.int64)
                n, v, d = np.zeros((3, b - a), np.int64)
                if bucket[a] >= 1 << bits:
                    real = keys != START
                    n[0], v[0], d[0] = total[real].sum(), (total[real] > 0).sum(), gone[real].sum()
                out = []
                for x in np.split(inverse, ends[:-1]):
                    out.append(_answer(np.stack([total[x], gone[x]])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[a:b]), pa.array(kind[a:b]), pa.array(bucket[a:b]), pa.array(out, pa.binary()), pa.array(n), pa.array(v), pa.array(d)], names=["chunk", "kind", "bucket", "blob", "n", "v", "d"]
                )

    return tidy(f)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)


def _merged(bits: int, fine: int, word_fine: int):
    """The rows of one group of chunks and one coarse bucket, as one for each fine bucket and kind; `part` takes the place of
    the chunk."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, "part"):
            part, bucket, kind = (table.column(c).to_numpy() for c in ("part", "bucket", "kind"))
            blobs = table.column("blob").combine_chunks()
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                n, base = (word_fine, 1 << fine) if bucket[a] >= 1 << bits else (fine, 0)
                rows: list[tuple] = []
                for k in np.unique(kind[a:b]).tolist():
                    keys, counts = _merge([_unpack(blobs[i].as_py()) for i in range(a, b) if kind[i] == k])
                    to = (keys >> np.uint64(64 - n)).astype(np.int64) if n else np.zeros(len(keys), np.int64)
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]])
                    rows += [(part[a], k, base + int(to[lo]), _pack(keys[lo:hi], counts[lo:hi])) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "kind", "bucket", "blob"])

    return tidy(f)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the rows of a part (answered -1) and the answers to it, sorted by fine bucket, the answer to each chunk."""
    for table, first in whole_groups(batches, "part"):
        chunk, kind, bucket, answered = (table.column(c).to_numpy() for c in ("chunk", "kind", "bucket", "answered"))
        blobs = table.column("blob").combine_chunks()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            cut = a + int(np.searchsorted(answered[a:b], 0))
            own = [_unpack(blobs[i].as_py())[0] for i in range(a, cut)]
            rows: list[tuple] = []
            for k in np.unique(kind[a:cut]).tolist():
                of = [i for i in range(a, cut) if kind[i] == k]
                keys = np.unique(np.concatenate([own[i - a] for i in of]))
                totals = np.concatenate([_planes(blobs[i].as_py()) for i in range(cut, b) if kind[i] == k], 1)
                rows += [(chunk[i], k, bucket[i], _answer(totals[:, np.searchsorted(keys, own[i - a])])) for i in of]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "kind", "bucket", "blob"])


def _answer(totals: np.ndarray) -> bytes:
    """Two rows of totals, byte by byte, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(totals, np.int64).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes())


def _planes(blob: bytes) -> np.ndarray:
    got = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return got.reshape(2, 8, -1).transpose(0, 2, 1).copy().view(np.uint64).reshape(2, -1)


def _met(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple]:
    """(ids, flags, tokens, totals and deleted counts of words, of pairs) of each chunk, from rows sorted by (chunk, bucket)."""
    for table, first in whole_groups(batches, "chunk"):
        bucket = table.column("bucket").to_numpy()
        col = {c: table.column(c).combine_chunks() for c in ("ids", "flags", "lens", "blob")}
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            flags = col["flags"][a].as_py()
            t = Tokens(col["blob"][a].as_py(), col["lens"][a].as_py(), flags)

            def totals(lo: int, hi: int) -> np.ndarray:
                return np.concatenate([_planes(col["blob"][i].as_py()) for i in range(lo, hi)], 1).astype(np.int64)  # noqa: B023

            cut = a + 1 + int(np.searchsorted(bucket[a + 1 : b], 1 << bits))
            yield col["ids"][a].as_py(), flags, t, totals(cut, b), totals(a + 1, cut)


def _bucket(c: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for none, then one an octave."""
    return np.minimum(np.frexp(c.astype(np.float64))[1], CONTEXTS - 1)


def _events(bits: int, n: int):
    """Histogram of the deleted documents' events under counts without them."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, t, w, p in _met(batches, bits):
            rest_w, rest_p = w[0] - w[1], p[0] - p[1]
            c2, cu, c1 = rest_p[t.pair], rest_w[t.context], rest_w[t.word]
            with np.errstate(divide="ignore", invalid="ignore"):
                q2 = np.where(c2 > 0, np.round(STEPS * np.log2(np.where(c2 > 0, c2, 1) / np.maximum(cu, 1))), 1)
                q1 = np.where(c1 > 0, np.round(STEPS * np.log2(np.where(c1 > 0, c1, 1))), -1)
            cell, count = np.unique(np.stack([_bucket(cu), q2.astype(np.int64), q1.astype(np.int64)]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in cell), pa.array(count)], names=["b", "q2", "q1", "n"])

    return tidy(f)


def expectation_maximisation(cells: np.ndarray, n: int, v: int) -> np.ndarray:
    """Weights (bucket, order 2 / 1 / 0) that make the events (b, q2, q1, count) likeliest."""
    weights = np.tile([0.5, 0.4, 0.1], (CONTEXTS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if not len(cells) or n <= 0:
        return weights if n > 0 else np.tile([0.0, 0.0, 1.0], (CONTEXTS, 1))
    b, q2, q1, count = cells.T
    p = np.stack([np.where(q2 <= 0, 2.0 ** (np.minimum(q2, 0) / STEPS), 0), np.where(q1 >= 0, 2.0 ** (q1 / STEPS) / n, 0), np.full(len(b), 1 / (v + 1))], 1)
    for _ in range(ROUNDS):
        part = weights[b] * p
        share = part / part.sum(1, keepdims=True) * count[:, None]
        total = np.zeros_like(weights)
        np.add.at(total, b, share)
        seen = total.sum(1) > 0
        # one pseudo-event a bucket keeps every weight of a seen order above 0
        total += weights
        weights[seen] = total[seen] / total[seen].sum(1, keepdims=True)
    return weights


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(bits: int, n: int, v: int, weights: np.ndarray):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flags, t, w, p in _met(batches, bits):
            c2, cu, c1 = p[0][t.pair], w[0][t.context], w[0][t.word]
            lam = weights[_bucket(cu)]
            prob = lam[:, 0] * (c2 / np.maximum(cu, 1)) + lam[:, 1] * (c1 / max(n, 1)) + lam[:, 2] / (v + 1)
            start = t.first[:-1]
            base = np.add.reduceat(np.log10((c1 + 0.1) / (n + 0.1 * (v + 1))), start)
            score = np.add.reduceat(np.log10(prob), start)
            known = np.add.reduceat((c1 > 0).astype(np.int64), start)
            cols = [pa.array(ids, pa.int64()), pa.array(np.array(flags) == HELD), pa.array(np.diff(t.first)), pa.array(known), pa.array(np.full(len(ids), n, np.int64)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in OUT.split(", ")])

    return tidy(f)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    work = Work(spark, "lm")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    flag = F.when(fold == 0, HELD).when(fold == 1, DELETED).otherwise(TRAIN).cast("int")
    d = docs.select(F.col("doc_id").cast("long"), flag.alias("flag"), "text")
    chunks = work.keep(d.mapInArrow(_chunked, CHUNK_SCHEMA), "chunks")
    size = chunks.agg(F.count("*").alias("n"), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x)).alias("bytes")).first()
    if not size["n"]:
        return docs.select(F.col("doc_id").cast("long")).withColumns({x.split()[0]: F.lit(None).cast(x.split()[1]) for x in OUT.split(", ")[1:]})
    fine = max(0, int((size["bytes"] // BUCKET_BYTES)).bit_length())
    word_fine = max(0, fine - 3)
    several = size["n"] > GROUP
    bits = min(fine, (GROUP - 1).bit_length()) if several else fine
    word_bits = min(word_fine, max(0, bits - 3))
    rows = "chunk long, kind int, bucket int, blob binary"

    def totals(counted: DataFrame) -> DataFrame:
        dealt = counted.repartition(parts_for(spark, (1 << fine) + (1 << word_fine), 2), "bucket").sortWithinPartitions("bucket")
        return work.keep(dealt.mapInArrow(_answered(fine), rows + ", n long, v long, d long"), "answers")

    counted = chunks.mapInArrow(_counted(bits, word_bits), rows)
    if several:
        groups = -(-size["n"] // GROUP)
        part = F.pmod("chunk", F.lit(groups)) * F.lit(1 << 20) + F.col("bucket")
        counted = work.keep(counted.withColumn("part", part), "counted")
        by_part = parts_for(spark, groups * ((1 << bits) + (1 << word_bits)), 2)
        merged = counted.repartition(by_part, "part").sortWithinPartitions("part").mapInArrow(_merged(bits, fine, word_fine), rows)
        answered = totals(merged)
        back = answered.select(F.col("chunk").alias("part"), F.lit(0).cast("long").alias("chunk"), "kind", F.lit(-1).alias("bucket"), "blob", F.col("bucket").alias("answered"))
        both = counted.select("part", "chunk", "kind", "bucket", "blob", F.lit(-1).alias("answered")).unionByName(back)
        answers = work.keep(both.repartition(by_part, "part").sortWithinPartitions("part", "answered").mapInArrow(_spread, rows), "spread")
    else:
        answered = answers = totals(counted)
    n, v, deleted = answered.agg(F.sum("n"), F.sum("v"), F.sum("d")).first()

    def met(c: DataFrame, a: DataFrame) -> DataFrame:
        rows = c.unionByName(a.select("chunk", "kind", "bucket", "blob"), allowMissingColumns=True)
        return rows.repartition(parts_for(spark, size["n"], 3), "chunk").sortWithinPartitions("chunk", "bucket")

    events = met(chunks.where(F.col("kind") == DELETED), answers.where(F.col("kind") == DELETED)).mapInArrow(_events(bits, n - deleted), "b int, q2 int, q1 int, n long")
    # at most CONTEXTS * (octaves of a ratio) * (octaves of a count) cells, whatever the corpus
    cells = np.array([tuple(r) for r in events.groupBy("b", "q2", "q1").agg(F.sum("n").alias("n")).collect()], np.int64).reshape(-1, 4)
    weights = expectation_maximisation(cells, n - deleted, v) if n - deleted > 0 else expectation_maximisation(cells[:0], n, v)
    return met(chunks, answers).mapInArrow(_scored(bits, n, v, weights), OUT)

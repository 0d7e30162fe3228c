"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask laid over consecutive words; only the positions marked 1 are hashed, so a substituted word under a
0 doesn't break the match. Seeds of test items and of documents are joined on their hash. Each diagonal (document
position minus item position) with a hit is verified word by word: the overlap is the longest stretch, over the whole item,
in which at least `similarity` of the words agree; it counts from `min_words` words on (or the whole of a shorter item).

Words are runs of letters, digits and non-ASCII symbols, lower-cased, so punctuation (ASCII or not) and case don't hide a
passage. A letter or mark of a script without spaces (Han, kana, Thai, Lao, Khmer, Burmese and others) is a word of its own.

Items under 12 words count only as a whole, with as many substitutions s as the similarity admits (none under 5 words: such
items must stand there verbatim). They get seeds of their own: cut into s + 2 blocks, at least two blocks are untouched, so
that the masks of all pairs of blocks miss nothing. A benchmark whose shortest items say too little names its floor, `least`.

The seeds of the test items are sent to every task where their texts have at most `BROADCAST_CHARS` signs (counted first);
then a document meets all items in its own task and nothing is shuffled. Larger benchmarks take the other way: seeds of
both sides are joined by hash, a bitmap of the items' hashes keeping back documents' seeds that meet none, hits are made distinct by diagonal, and texts are joined to them for the same verification.

Defined results: null and empty texts and items match nothing; items under `least` words (none by default) are ignored; one row for each
row of docs and row of items, with the longest overlap (the first on ties), so that repeated rows of either give repeated
rows in both ways; null ids are carried; an empty table gives an empty result; other
columns are ignored by `matches` and kept by `clean`.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ._spark import Work, keyed
from ._units import LOWER, groups, mix, raw, signed, tidy, words

#: Spaced seeds (fixed values): they ignore one to four words.
MASKS = ("1111011", "111010011", "1101001011", "1100110101")
SIMILARITY, MIN_WORDS = 0.8, 12
BROADCAST_CHARS = 16_000_000
#: The bitmap of items' seeds in front of the join by seed: 2**26 bits, 8 MB.
FILTER_BITS = 26

_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32
_COEF = np.random.default_rng(99).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

MATCH_SCHEMA = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_same long"
KEY_SCHEMA = "k1 long, k2 long, i1 long, i2 long, doc_start long, item_start long, n_words long, n_same long"
SALTS, DIAGONALS = 8, 4096


#: Blocks whose letters are written without spaces: Thai and Lao, Burmese, Khmer, Tai scripts, Han, kana.
_UNSPACED = (
    (0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0), (0x2E80, 0x2FE0), (0x3005, 0x3008), (0x3021, 0x3100), (0x31F0, 0x3200),
    (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xA9E0, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, 0x32400),
)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """By code point: 1 for punctuation and spaces, 2 for what is a word of its own, else 0; ASCII is left to _PLAIN."""
    kind = np.zeros(0x110000, np.uint8)
    for lo, hi in _UNSPACED:
        kind[[c for c in range(lo, hi) if unicodedata.category(chr(c)) in ("Lo", "Lm", "Mn", "Mc", "Nl")]] = 2
    kind[[c for c in range(128, 0x20000) if unicodedata.category(chr(c))[0] in "PZ" or c == 0x85]] = 1
    return kind


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    plain = _PLAIN[data]
    p = np.flatnonzero(data >= 0xC0)
    if len(p):
        n = 2 + (data[p] >= 0xE0) + (data[p] >= 0xF0)
        point = data[p].astype(np.int64) & np.array([0x1F, 0xF, 7])[n - 2]
        for j in (1, 2, 3):
            point = np.where(n > j, point << 6 | data[np.minimum(p + j, len(data) - 1)] & 0x3F, point)
        kind = _kinds()[point]
        for j in range(4):
            plain[p[(kind == 1) & (n > j)] + j] = 32
        own = kind == 2
        if own.any():
            gaps = np.unique(np.concatenate([p[own], p[own] + n[own]]))
            plain, offs = np.insert(plain, gaps, 32), offs + np.searchsorted(gaps, offs)
    return words(plain, offs)


def seeds(values: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask at every position where it fits, over concatenated rows."""
    n = len(values) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(len(mask) * 1000003 + int(mask, 2)))
    for j, one in enumerate(mask):
        if one == "1":
            h += values[j : j + n] * _COEF[j]
    return mix(h)


def _masks(lengths: np.ndarray, similarity: float, least: int = 1) -> list[tuple[str, bool]]:
    """The fixed masks, and (True) those that cover the whole of an item of their own length, for items of under MIN_WORDS."""
    out = [(m, False) for m in MASKS]
    for n in np.unique(lengths).tolist():
        if max(1, least) <= n < MIN_WORDS:
            blocks = min(n, int((1 - similarity) * n + 1e-9) + 2)
            of = np.arange(n) * blocks // n
            out += [("".join("01"[int(k in pair)] for k in of), True) for pair in combinations(range(blocks), min(2, blocks))]
    return out


class Items:
    """Test items with their seeds, sorted by hash behind a bitmap that most lookups end at."""

    def __init__(self, ids: list[int | None], texts: list[str | None], similarity: float = SIMILARITY, least: int = 1):
        data, offs = raw(pa.array(texts, pa.string()))
        self.values, self.first = tokens(data, offs)
        self.ids = ids
        lens = np.diff(self.first)
        masks = _masks(lens, similarity, least)
        self.masks = [m for m, _ in masks]
        h, item, at = [], [], []
        for mask, whole in masks:
            s = seeds(self.values, mask)
            row = np.searchsorted(self.first, np.arange(len(s)), "right") - 1
            ok = np.arange(len(s)) + len(mask) <= self.first[row + 1]
            ok &= lens[row] == len(mask) if whole else lens[row] >= least
            h.append(s[ok])
            item.append(row[ok])
            at.append(np.flatnonzero(ok) - self.first[row[ok]])
        h, item, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (h, item, at))
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.at = h[order], item[order], at[order]
        self.bits = max(16, min(23, int(len(h) * 32).bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._low(self.hash)] = True

    def _low(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def hits(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (row, item, diagonal) at which a seed of a row and one of an item agree."""
        out = []
        for mask in self.masks:
            s = seeds(values, mask)
            p = np.flatnonzero(self.seen[self._low(s)])
            lo, hi = np.searchsorted(self.hash, s[p], "left"), np.searchsorted(self.hash, s[p], "right")
            p, lo, n = p[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            row = np.searchsorted(first, p, "right") - 1
            ok = p + len(mask) <= first[row + 1]
            p, lo, n, row = p[ok], lo[ok], n[ok], row[ok]
            e = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, p = np.repeat(row, n), np.repeat(p, n)
            out.append(np.stack([row, self.item[e], p - first[row] - self.at[e]], 1))
        both = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)
        return both[:, 0], both[:, 1], both[:, 2]


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, similarity: float, min_words: int) -> tuple[int, int, int, int] | None:
    """(doc_start, item_start, n_words, n_same) of the longest stretch of the diagonal that agrees well enough."""
    a, b = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    same = doc[a + diagonal : b + diagonal] == item[a:b]
    gain = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - similarity, -similarity))])
    # the longest i < j with gain[j] >= gain[i]: a falling running minimum from the left, a running maximum from the right
    least = np.minimum.accumulate(gain)
    best = None
    top = np.maximum.accumulate(gain[::-1])[::-1]
    i = j = 0
    while j < len(gain):
        if top[j] >= least[i] - 1e-9:
            if best is None or j - i > best[1] - best[0]:
                best = (i, j)
            j += 1
        else:
            i += 1
            j = max(j, i)
    if best is None:
        return None
    i, j = best
    i = int(np.flatnonzero(gain[: i + 1] <= least[i] + 1e-12)[0])
    j = int(np.flatnonzero(gain[j:] >= gain[i] - 1e-9)[-1]) + j
    if j - i < min(min_words, len(item)):
        return None
    return a + i + diagonal, a + i, j - i, int(same[i:j].sum())


@lru_cache(2)
def _items(ids: tuple, texts: tuple, similarity: float, least: int) -> Items:
    return Items(list(ids), list(texts), similarity, least)


def _searched(sent: Broadcast, similarity: float, min_words: int, least: int):
    """sent: ids and texts of the items, a broadcast variable that a worker unpickles once for all its tasks."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = sent.value
        items = _items(ids, texts, similarity, least)
        for batch in batches:
            data, offs = raw(batch.column("text"))
            doc_id = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for lo, hi in groups(offs):
                values, first = tokens(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                best: dict[tuple[int, int], tuple] = {}
                for row, item, diagonal in zip(*(x.tolist() for x in items.hits(values, first)), strict=True):
                    found = overlap(values[first[row] : first[row + 1]], items.values[items.first[item] : items.first[item + 1]], diagonal, similarity, min_words)
                    if found and ((row, item) not in best or (found[2], -found[0]) > (best[row, item][2], -best[row, item][0])):
                        best[row, item] = found
                rows += [(doc_id[lo + row], ids[item], *x) for (row, item), x in best.items()]
            if rows:
                yield _packed(rows)

    return tidy(f)


def _packed(rows: list[tuple], schema: str = MATCH_SCHEMA) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=[x.split()[0] for x in schema.split(", ")])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of words under MIN_WORDS that occur in a batch."""
    for batch in batches:
        data, offs = raw(batch.column("text"))
        for lo, hi in groups(offs):
            n = np.unique(np.diff(tokens(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])[1]))
            yield pa.RecordBatch.from_arrays([pa.array(n[n < MIN_WORDS], pa.int64())], names=["n"])


def _seeded(masks: tuple[tuple[str, bool], ...], key: tuple[str, ...], of_items: bool, least: int = 1, wanted: Broadcast | None = None):
    """Rows (key, at, hash) of all seeds; of_items: masks of a whole item only over rows of their own length. wanted: a bitmap by
    the first bits of a hash; a seed whose bit isn't set meets no item and goes before the shuffle."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(zlib.decompress(wanted.value), np.uint8) if wanted else None
        for batch in batches:
            data, offs = raw(batch.column("text"))
            for lo, hi in groups(offs):
                values, first = tokens(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                for mask, whole in masks:
                    s = seeds(values, mask)
                    row = np.searchsorted(first, np.arange(len(s)), "right") - 1
                    ok = np.arange(len(s)) + len(mask) <= first[row + 1]
                    if of_items:
                        ok &= np.diff(first)[row] == len(mask) if whole else np.diff(first)[row] >= least
                    if bits is not None:
                        ok &= (bits[(s >> np.uint64(64 - FILTER_BITS + 3)).astype(np.int64)] >> ((s >> np.uint64(64 - FILTER_BITS)) & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    row = row[ok]
                    cols = [batch.column(c).take(pa.array(lo + row)) for c in key]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(np.flatnonzero(ok) - first[row]), pa.array(signed(s[ok]))], names=[*key, "at", "hash"])

    return tidy(f)


def _filter(of_items: DataFrame) -> Broadcast:
    """One bit for each first FILTER_BITS bits of a hash that an item's seed has. Bytes of the bitmap are aggregates: a group
    a byte that is set, so that what comes to the driver is bounded by the bitmap and not by the items."""
    rows = of_items.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).cast("int").alias("place")).selectExpr("place div 8 AS byte", "1 << (place % 8) AS bit")
    table = rows.groupBy("byte").agg(F.bit_or("bit").cast("int").alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    bits[table.column("byte").to_numpy()] = table.column("bits").to_numpy()
    return of_items.sparkSession.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1))


def _checked(similarity: float, min_words: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *key, text, item, diagonals in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "i1", "i2", "text", "item", "diagonals")), strict=True):
                a, b = (tokens(*raw(pa.array([x])))[0] for x in (text, item))
                found = [x for d in sorted(diagonals) if (x := overlap(a, b, d, similarity, min_words))]
                if found:
                    rows.append((*key, *max(found, key=lambda x: (x[2], -x[0]))))
            if rows:
                yield _packed(rows, KEY_SCHEMA)

    return tidy(f)


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, broadcast_chars: int = BROADCAST_CHARS, least: int = 1) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_same (in words) for every document that holds an item."""
    items = items.select(F.col("item_id").cast("long"), F.lower("text").alias("text")).where("text IS NOT NULL")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if total <= broadcast_chars:
        got = sorted(((r[0], r[1]) for r in items.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ids, texts = tuple(r[0] for r in got), tuple(r[1] for r in got)
        sent = docs.sparkSession.sparkContext.broadcast((ids, texts))
        return docs.mapInArrow(_searched(sent, similarity, min_words, least), MATCH_SCHEMA)
    work = Work(docs.sparkSession, "seeds")
    short = [r[0] for r in items.select("text").mapInArrow(_lengths, "n long").distinct().collect()]
    masks = tuple(_masks(np.array(short, np.int64), similarity, least))
    i = items.withColumns({"i1": F.coalesce("item_id", F.lit(-(2**63))), "i2": F.xxhash64("text")})
    d = keyed(docs, "doc_id", "text")
    of_items = work.keep(i.mapInArrow(_seeded(masks, ("i1", "i2"), True, least), "i1 long, i2 long, at long, hash long"), "items")
    of_docs = d.mapInArrow(_seeded(masks, ("k1", "k2"), False, wanted=_filter(of_items)), "k1 long, k2 long, at long, hash long")
    # a seed that very many documents hold is dealt to SALTS tasks, each with its own copy of the items' seeds
    salted = of_items.select("i1", "i2", F.col("at").alias("q"), "hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = of_docs.withColumn("salt", F.pmod(F.xxhash64("k1", "k2", "at"), F.lit(SALTS)).cast("int")).join(salted, ["hash", "salt"])
    met = met.select("k1", "k2", "i1", "i2", (F.col("at") - F.col("q")).alias("diagonal")).distinct()
    # diagonals travel in stretches of DIAGONALS, so that no list grows with a text that repeats itself
    hits = met.groupBy("k1", "k2", "i1", "i2", F.floor(F.col("diagonal") / DIAGONALS).alias("stretch")).agg(F.collect_list("diagonal").alias("diagonals"))
    hits = work.keep(hits.drop("stretch"), "hits")
    one_item = i.select("i1", "i2", F.col("text").alias("item")).dropDuplicates(["i1", "i2"])
    full = hits.join(one_item, ["i1", "i2"]).join(d.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]), ["k1", "k2"])
    found = full.select("k1", "k2", "i1", "i2", "text", "item", "diagonals").mapInArrow(_checked(similarity, min_words), KEY_SCHEMA)
    # the longest, the first on ties; then every row of either side comes back, repeated ones too
    best = found.groupBy("k1", "k2", "i1", "i2").agg(F.max(F.struct("n_words", (-F.col("doc_start")).alias("minus"), (-F.col("item_start")).alias("less"), "n_same")).alias("b"))
    both = best.join(i.select("i1", "i2", "item_id"), ["i1", "i2"]).join(d.select("k1", "k2", "doc_id"), ["k1", "k2"])
    return both.select("doc_id", "item_id", (-F.col("b.minus")).alias("doc_start"), (-F.col("b.less")).alias("item_start"), "b.n_words", "b.n_same")


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, least: int = 1) -> DataFrame:
    """docs without those that hold an item, whole rows and all columns."""
    m = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k1"), F.xxhash64("text").alias("k2"), "text")
    # the key travels as id through matches, so that null and repeated ids stay apart
    marked = m.select(F.xxhash64("k1", "k2").alias("doc_id"), "text")
    (key,) = unused(docs, "row_key")
    bad = matches(marked, items, similarity, min_words, least=least).select(F.col("doc_id").alias(key)).distinct()
    keyed_docs = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.xxhash64("text")))
    return keyed_docs.join(bad, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])

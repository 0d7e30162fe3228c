"""Language identification with string kernels.

The kernel is the blended spectrum in its presence form: K(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|), where G holds a
text's character 1-, 2- and 3-grams (lower-cased, all but letters and marks as one blank) out of a vocabulary of the n-grams
that most sample texts hold, each language bringing its share. Landmark texts give the Nystroem map K_xm K_mm^-1/2, in
which kernel ridge regression is solved once for all languages, one against the rest. Prediction is a narrow map over whole
texts: per piece one lookup for the presences and two matrix products.

The fit uses a bounded sample: `SAMPLE_ROWS` labelled rows in all or `LEAST_ROWS` a language, whichever is more, an equal share a
language, by a hash of doc_id and text. Rows of up to `SAMPLE_CHARS` signs are preferred, longer ones taken whole where a language
has no others. Sampling is a filter after a count by language, so no key is gathered in one task; every language that
occurs is learned. Vocabulary and landmarks grow with the number of languages beyond about a hundred.

Defined results: a null text, or one without a letter, is `und` with score 0; a training row whose text or lang is null
teaches nothing; with no training rows everything is `und`; repeated rows count once in the fit and are predicted as any
other, as are null ids; ties between languages go to the first by name; other columns are never read, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ._units import PIECE, groups, in_slices, raw, tidy

SAMPLE_ROWS, LEAST_ROWS, SAMPLE_CHARS = 2400, 8, 20_000
#: At least so many n-grams and landmarks in all, and for each language.
FEATURES, LANDMARKS = (6144, 64), (128, 2)
RIDGE = 1e-3
#: Numbers of presences a piece holds at once, however short its texts.
CELLS = 1_600_000
UND = "und"

#: Letters and marks of Unicode stand below it.
_END = 0x33480
_SLOTS = 22


@lru_cache(1)
def _classes() -> np.ndarray:
    """By code point: its lower case for a letter or mark, else a blank."""
    out = np.full(_END, 32, np.int32)
    for c in range(_END):
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LM":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(_END)])


def points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 rows, those beyond all letters as 0, and each row's first (len + 1)."""
    lead = (data & 0xC0) != 0x80
    if lead.all():
        return data.astype(np.int32), offs
    p = np.flatnonzero(lead)
    out = data[p].astype(np.int32)
    wide = np.flatnonzero(out >= 0xC0)
    q, first = p[wide], out[wide]
    n = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = first & np.array([0x1F, 0xF, 7], np.int32)[n - 2]
    for j in (1, 2, 3):
        point = np.where(n > j, point << 6 | data[np.minimum(q + j, len(data) - 1)] & 0x3F, point)
    out[wide] = np.where(point < _END, point, 0)
    return out, np.searchsorted(p, offs)


def _codes(chars: np.ndarray) -> list[np.ndarray]:
    """Codes of the 1-, 2- and 3-grams at every character, 20 bits for each and one for the length."""
    c = _classes()[chars].astype(np.int64)
    two = c[:-1] << 20 | c[1:] if len(c) > 1 else c[:0]
    three = two[:-1] << 20 | c[2:] if len(c) > 2 else c[:0]
    return [c | 1 << 61, two | 1 << 62, three]


@dataclass(frozen=True, eq=False)
class Model:
    langs: list[str]
    vocab: np.ndarray  # sorted codes
    landmarks: np.ndarray  # bits, a row each
    weights: np.ndarray  # from kernel values to a column for each language
    bias: np.ndarray

    def prepared(self) -> tuple[Lookup, np.ndarray]:
        return _prepared(self.vocab.tobytes(), self.landmarks.tobytes(), len(self.landmarks))


class Lookup:
    """The n-grams at every character of a text, as places in the vocabulary from 1 on; 0 for none.

    Vocabularies of up to 255 characters have a table by the numbers of three characters; others are looked up by a hash,
    codes that share a slot in a further table."""

    def __init__(self, vocab: np.ndarray):
        self.vocab = np.concatenate([[-1], vocab])
        size = np.where(vocab >> 62 & 1, 2, np.where(vocab >> 61 & 1, 1, 3))
        part = [np.where(size > k, vocab >> 20 * k & 0xFFFFF, 0) for k in range(3)]  # the last character first
        used = np.unique(np.concatenate(part))
        used = used[used > 0]
        self.narrow = len(used) < 256
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        if self.narrow:
            own = np.zeros(_END, np.int32)
            own[used] = np.arange(1, len(used) + 1)
            self.own = own[_classes()].astype(np.uint8)
            self.base = n = len(used) + 1
            self.table = np.zeros(n**3 + n**2 + n, np.int16 if len(vocab) < 1 << 15 else np.int32)
            code = own[part[0]] + n * own[part[1]] + n * n * own[part[2]]
            self.table[code + np.where(size == 2, n**3, 0) + np.where(size == 1, n**3 + n**2, 0)] = np.arange(1, len(vocab) + 1)
            return
        left = np.arange(1, len(self.vocab))
        salt = 0
        while len(left):
            salt += 1
            slot = self._slot(self.vocab[left], np.uint64(salt))
            _, one = np.unique(slot, return_index=True)
            table = np.zeros(1 << _SLOTS, np.int32)
            table[slot[one]] = left[one]
            self.tables.append((np.uint64(salt), table))
            left = np.delete(left, one)

    @staticmethod
    def _slot(codes: np.ndarray, salt: np.uint64) -> np.ndarray:
        h = (codes.view(np.uint64) + salt) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _SLOTS)

    def _place(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int32)
        for salt, table in self.tables:
            at = table[self._slot(codes, salt)]
            hit = np.flatnonzero(at)
            at = at[hit]
            same = self.vocab[at] == codes[hit]
            out[hit[same]] = at[same]
        return out

    def __call__(self, chars: np.ndarray) -> list[np.ndarray]:
        """Places of the 1-, 2- and 3-grams at every character."""
        if not self.narrow:
            return [self._place(c) for c in _codes(chars)]
        n, b = self.base, self.own[chars].astype(np.int32)
        two = b[:-1] * n + b[1:]
        three = two[:-1] * n + b[2:]
        # a character outside the vocabulary is number 0, so that its n-grams have codes that no entry has
        return [self.table[b + (n**3 + n**2)], self.table[two + n**3], self.table[three]]


@lru_cache(1)
def _prepared(vocab: bytes, landmarks: bytes, m: int) -> tuple[Lookup, np.ndarray]:
    """The vocabulary's lookup, and the landmarks' normalised presences."""
    codes = np.frombuffer(vocab, np.int64)
    bits = np.unpackbits(np.frombuffer(landmarks, np.uint8).reshape(m, -1), axis=1)[:, : len(codes)].astype(np.float32)
    return Lookup(codes), (bits / np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1))).T.copy()


def presences(chars: np.ndarray, offs: np.ndarray, lookup: Lookup, size: int) -> np.ndarray:
    """Rows of 0 and 1 over the vocabulary; column 0 gathers what isn't in it."""
    out = np.zeros((len(offs) - 1, size + 1), np.float32)
    flat = out.reshape(-1)
    for a in range(0, max(1, len(chars)), PIECE):
        part = chars[a : a + PIECE + 2]
        row = np.searchsorted(offs, np.arange(a, a + len(part)), "right") - 1
        left = offs[row + 1] - np.arange(a, a + len(part))  # characters to the row's end
        row *= size + 1
        for n, places in enumerate(lookup(part), 1):
            flat[(row[: len(places)] + places)[left[: len(places)] >= n]] = 1
    return out[:, 1:]


def _rows(size: int) -> int:
    return max(16, CELLS // (size + 1))


def _kernel(p: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return (p @ marks) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))


def _sample(train: DataFrame) -> list[tuple[str, str]]:
    """(lang, text) of the rows to learn from, in the order of their lots."""
    lot = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("langid")), F.lit(1 << 40)) / float(1 << 40)
    t = train.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", lot.alias("lot"), (F.length("text") > SAMPLE_CHARS).alias("long"))
    # a row a language: how many different rows it has, and the first by lot
    seen = t.select("lang", "long", "lot").distinct().groupBy("lang", "long").agg(F.count("*").alias("n"), F.min("lot").alias("least"))
    best = seen.groupBy("lang").agg(F.min(F.struct("long", "n", "least")).alias("b")).select("lang", "b.*").collect()
    if not best:
        return []
    share = max(LEAST_ROWS, SAMPLE_ROWS // len(best))
    want = [(r["lang"], r["long"], max(r["least"], min(1.0, (LEAST_ROWS if r["long"] else share) / r["n"]))) for r in best]
    chance = t.sparkSession.createDataFrame(want, "lang string, long boolean, chance double")
    rows = t.join(F.broadcast(chance), ["lang", "long"]).where("lot <= chance")  # a row a language
    rows = rows.select("lang", "text", "lot", (F.col("lot") / F.col("chance")).alias("turn")).dropDuplicates(["lang", "lot"])
    rows = rows.orderBy("turn", "lang", F.xxhash64("text")).limit(2 * share * len(best)).collect()
    return [(r["lang"], r["text"]) for r in rows]


def _vocabulary(each: list[np.ndarray], lang: np.ndarray, n_langs: int) -> np.ndarray:
    """The n-grams that most texts of a language hold, an equal number a language, then those that most texts hold."""
    size = max(FEATURES[0], FEATURES[1] * n_langs)
    codes, df = np.unique(np.concatenate(each), return_counts=True)
    chosen = np.zeros(len(codes), bool)
    for k in range(n_langs):
        own, n = np.unique(np.concatenate([e for e, x in zip(each, lang, strict=True) if x == k]), return_counts=True)
        chosen[np.searchsorted(codes, own[np.argsort(-n, kind="stable")[: size // (2 * n_langs)]])] = True
    rest = np.argsort(np.where(chosen, 0, -df), kind="stable")[: max(0, size - int(chosen.sum()))]
    chosen[rest] = True
    return codes[chosen]


def fit(train: DataFrame) -> Model | None:
    """train: doc_id, text, lang."""
    rows = _sample(train)
    if not rows:
        return None
    texts = [t.encode() for _, t in rows]
    chars, offs = points(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    each = [np.unique(np.concatenate(_codes(chars[a:b]))) for a, b in zip(offs, offs[1:], strict=False)]
    langs = sorted({x for x, _ in rows})
    number = {x: k for k, x in enumerate(langs)}
    lang = np.array([number[x] for x, _ in rows])
    vocab = _vocabulary(each, lang, len(langs))
    lookup, size = Lookup(vocab), len(vocab)
    p = np.concatenate([presences(chars[offs[a] : offs[b]], offs[a : b + 1] - offs[a], lookup, size).astype(bool) for a, b in groups(offs, rows=_rows(size))])
    # landmarks in turn from each language, by lot
    turn = np.zeros(len(rows), np.int64)
    for k in range(len(langs)):
        turn[lang == k] = np.arange((lang == k).sum())
    chosen = np.lexsort((lang, turn))[: max(LANDMARKS[0], LANDMARKS[1] * len(langs))]
    marks = p[chosen].astype(np.float32)
    marks = (marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))).T
    step = _rows(size)
    k_xm = np.concatenate([_kernel(p[a : a + step].astype(np.float32), marks) for a in range(0, len(p), step)]).astype(np.float64)
    return Model(langs, vocab, np.packbits(p[chosen], axis=1), *_ridge(k_xm, k_xm[chosen], lang, len(langs)))


def _ridge(k_xm: np.ndarray, k_mm: np.ndarray, lang: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias on kernel values with the landmarks: ridge regression of +1 and -1 in the Nystroem map, languages of
    equal weight."""
    value, vector = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    z = k_xm @ root
    y = np.where(lang[:, None] == np.arange(n_langs), 1.0, -1.0)
    weight = 1.0 / np.bincount(lang, minlength=n_langs)[lang]
    weight /= weight.mean()
    zm, ym = np.average(z, 0, weight), np.average(y, 0, weight)
    zc = z - zm
    a = (zc * weight[:, None]).T @ zc + RIDGE * len(z) * np.eye(z.shape[1])
    w = np.linalg.solve(a, (zc * weight[:, None]).T @ (y - ym))
    return (root @ w).astype(np.float32), (ym - zm @ w).astype(np.float32)


def _predict(model: Model | None, names: tuple[str, str]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, -1):
            n = len(batch)
            pred, score = np.full(n, UND, object), np.zeros(n)
            data, offs = raw(batch.column(batch.num_columns - 1))
            if model is not None:
                lookup, marks = model.prepared()
                for lo, hi in groups(offs, rows=_rows(len(model.vocab))):
                    chars, o = points(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                    letters = np.concatenate([[0], np.cumsum(_letters()[chars])])
                    plain = letters[o[1:]] > letters[o[:-1]]
                    if not plain.any():
                        continue
                    out = _kernel(presences(chars, o, lookup, len(model.vocab)), marks) @ model.weights + model.bias
                    best = out.argmax(1)
                    top = out[np.arange(len(out)), best]
                    out[np.arange(len(out)), best] = -np.inf
                    second = out.max(1) if out.shape[1] > 1 else np.full(len(out), -1.0)
                    pred[lo:hi][plain] = np.array(model.langs, object)[best[plain]]
                    score[lo:hi][plain] = np.clip(0.5 + (top - second)[plain].astype(float) / 4, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(batch.num_columns - 1)), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[:-1], *names],
            )

    return tidy(f)


def predict(docs: DataFrame, model: Model | None, *carry: str, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns named in carry, the language and its score under `names`, from column text alone."""
    (text,) = unused(docs, "whole_text")
    d = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])
    return d.mapInArrow(_predict(model, names), f"{fields}{', ' if fields else ''}`{names[0]}` string, `{names[1]}` double")


def remainder(modulus: int):
    """crc32(doc_id as text) mod modulus; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows whose remainder by 3 isn't 1. A null id is not held out."""
    d = docs.select(F.col("doc_id").cast("long"), "text", "lang").withColumn("held_out", F.coalesce(remainder(3) == 1, F.lit(False)))
    model = fit(d.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return predict(d, model, "doc_id", "held_out")


def identified(docs: DataFrame) -> DataFrame:
    """docs without those in no language (null or letterless text); a null lang takes the prediction."""
    model = fit(docs.select("doc_id", "text", "lang"))
    pred, score = unused(docs, "lang_pred", "score")
    out = predict(docs, model, *docs.columns, names=(pred, score)).where(F.col(pred) != UND)
    return out.withColumn("lang", F.coalesce("lang", pred)).select(*[f"`{c}`" for c in docs.columns])

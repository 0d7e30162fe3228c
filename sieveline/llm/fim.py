"""Fill-in-middle transformation by a constant-memory two-pass streaming matcher.

A unit is a match of UNITS: white space and the word after it, or the white space at the end; units cover a text without gaps.
The first pass over a text counts its units. Two of the n + 1 borders between them are drawn by a hash of the document's id;
the second pass advances a lazy iterator of matches to the one and then on to the other. No list of units, offsets or tokens is
ever held: beside a text, its output and one match object nothing is in memory. Texts that are to stay plain are passed once.

Draws depend on nothing but seed and id, so a lost task gives the same rows when it runs again. It is a narrow map: no shuffle.

Defined results: a null text counts as empty and is plain; a null id is hashed as an empty string; a text that holds one of the
marks is plain, so that every output can be taken apart again; repeated rows and equal ids stay rows of their own (equal ids
draw the same numbers); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._units import in_slices, tidy

UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Marks before prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, CHANGED, SUFFIX_FIRST = 42, 50, 80

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def count(units: re.Pattern, text: str) -> int:
    n = 0
    for n, _ in enumerate(units.finditer(text), 1):
        pass
    return n


def borders(units: re.Pattern, text: str, first: int, second: int) -> tuple[int, int]:
    """Where the first `first` and the first `second` units end, first <= second."""
    matches = units.finditer(text)
    ends = []
    for skip in (first, second - first):
        m = next(islice(matches, skip - 1, None)) if skip else None
        ends.append(m.end() if m else ends[-1] if ends else 0)
    return ends[0], ends[1]


def arranged(units: re.Pattern, text: str, doc_id: int | None, seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    n = count(units, text)
    sha = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(sha[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= changed or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    a, b = borders(units, text, *sorted((h1 % (n + 1), h2 % (n + 1))))
    if h4 % 100 < suffix_first:
        form, parts = "spm", (SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])
    else:
        form, parts = "psm", (PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])
    return n, form, a, b - a, "".join(parts)


def _mapped(seed: int, changed: int, suffix_first: int, pattern: str):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = re.compile(pattern)
        for batch in in_slices(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows = [(i, *arranged(units, texts[k].as_py() or "", i, seed, changed, suffix_first)) for k, i in enumerate(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return tidy(f)


def transform(docs: DataFrame, seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST, pattern: str = UNITS) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars and middle_chars (null where plain), output.

    changed: how many in a hundred are to be rearranged; suffix_first: how many in a hundred of those are spm. pattern: units
    that cover every text without gaps."""
    d = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return d.mapInArrow(_mapped(seed, changed, suffix_first, pattern), SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from. No part holds a mark, so the three marks cut it into exactly its parts."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    t = transform(docs)
    return t.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))

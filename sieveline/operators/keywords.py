"""Long lists of literal keywords, searched in one pass over each text however many there are.

A list is given as rows (group, keyword). It is dealt into blocks of bounded size; a block is a broadcast variable and becomes
an automaton once a worker, so a text costs its length and not its length times the number of keywords. Rows stay where they
are: nothing is shuffled. Letters are compared as `functions.text.matches_any` does, case folded one code point at a time.

Defined results: a null text is empty; an empty keyword is in every text; null keywords and groups are left out; keywords that
are repeated, or are one when folded, count once a group; a list without rows gives no hits."""

from __future__ import annotations

import uuid

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ..sources.tables import settled

#: Letters of keywords and group names in one block.
BLOCK = 4_000_000


class _Folds(dict):
    """Code point to code point: upper case, then lower case, where these are one letter each."""

    def __missing__(self, c: int) -> int:
        up = chr(c).upper()
        self[c] = ord((up if len(up) == 1 else chr(c)).lower()[0])
        return self[c]


FOLDS = _Folds()
_built: dict[str, tuple[ahocorasick.Automaton | None, frozenset[str]]] = {}


def fold(text: str) -> str:
    return text.translate(FOLDS)


def automaton(pairs: list[tuple[str, str]]) -> tuple[ahocorasick.Automaton | None, frozenset[str]]:
    """Keywords to their groups, and the groups that hold the empty keyword."""
    groups: dict[str, set[str]] = {}
    for group, keyword in pairs:
        groups.setdefault(fold(keyword), set()).add(group)
    always = frozenset(groups.pop("", ()))
    if not groups:
        return None, always
    auto = ahocorasick.Automaton()
    for keyword, of in groups.items():
        auto.add_word(keyword, tuple(sorted(of)))
    auto.make_automaton()
    return auto, always


def _finder(held, name: str):
    """A function of a text column: the groups of a broadcast block that have a keyword in it. Workers know the block by name."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        if name not in _built:
            _built.clear()  # a worker holds one block
            _built[name] = automaton(held.value)
        auto, always = _built[name]
        out = []
        for text in texts:
            hits = set(always)
            if auto is not None and text:
                for _, of in auto.iter(fold(text)):
                    hits.update(of)
            out.append(list(hits))
        return pd.Series(out)

    return found


def blocks(keywords: DataFrame, block: int = BLOCK) -> list[list[tuple[str, str]]]:
    """The distinct pairs in blocks of at most `block` letters (one pair at least)."""
    out: list[list[tuple[str, str]]] = []
    size = block
    pairs = keywords.select(F.col("group").cast("string"), F.col("keyword").cast("string")).dropna().distinct()
    for group, keyword in pairs.toLocalIterator():
        size += len(group) + len(keyword)
        if not out or size > block:
            out.append([])
            size = len(group) + len(keyword)
        out[-1].append((group, keyword))
    return out


def with_hits(df: DataFrame, text: str, keywords: DataFrame, name: str = "hits", block: int = BLOCK) -> DataFrame:
    """df with the groups that have a keyword in the text, an ordered array. keywords: group, keyword. A list of more than one
    block is searched block by block over the same rows, written in between."""
    context = df.sparkSession.sparkContext
    (found,) = unused(df.withColumn(name, F.lit(None)), "found")
    out = df.withColumn(name, F.array().cast("array<string>"))
    for i, pairs in enumerate(blocks(keywords, block)):
        if i:
            out = settled(out, "hits")  # so that no task needs two blocks
        find = _finder(context.broadcast(pairs), uuid.uuid4().hex)
        out = out.withColumn(found, find(F.coalesce(F.col(f"`{text}`"), F.lit("")))).withColumn(name, F.concat(F.col(f"`{name}`"), found)).drop(found)
    return out.withColumn(name, F.array_sort(F.array_distinct(f"`{name}`")))


def hit_rates(df: DataFrame, label: str, text: str, keywords: DataFrame, block: int = BLOCK) -> DataFrame:
    """(label, scenario, count, total, rate) for the pairs that occur: rows of a label with a keyword of the scenario, of all
    its rows. A null label is a label of its own. Rows leave the scan as a label and its hits; counts are combined before the
    shuffle."""
    hit = with_hits(df.select(F.col(f"`{label}`").alias("label"), F.col(f"`{text}`").alias("text")), "text", keywords, block=block)
    # an empty scenario stands for the row itself, so that one pass counts both
    long = hit.select("label", F.explode(F.concat(F.array(F.lit(None).cast("string")), "hits")).alias("scenario"))
    counts = long.groupBy("label", "scenario").agg(F.count("*").alias("count"))
    totals = counts.where("scenario IS NULL").select(F.col("label").alias("of"), F.col("count").alias("total"))
    c = counts.where("scenario IS NOT NULL").join(totals, F.col("label").eqNullSafe(F.col("of")))
    return c.select(F.col("label").alias(label), "scenario", "count", "total", F.round(F.col("count") / F.col("total"), 4).alias("rate"))

"""Fixed-width keys for grouping and joining by text, and names for helper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def halves(key: Column) -> tuple[Column, Column]:
    """128 bits of a key as two longs: what a shuffle carries and a hash aggregate groups by, whatever the text's length. Null
    is a key of its own. Unequal keys that agree in both halves aren't to be expected in any corpus."""
    return F.xxhash64(key), F.xxhash64(F.lit("second half"), key)


def row_lot(df: DataFrame) -> Column:
    """A number from all columns that can be hashed: decides between rows that tie, the same way on every run."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])

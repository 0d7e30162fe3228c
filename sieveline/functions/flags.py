"""Flags, labels, ids and small conversions as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normalise, py_strip


def to_binary(x: Column | str) -> Column:
    """1 for 1, 1.0, true, yes, y, t in any case and for numbers equal to 1; else 0, null and blank too."""
    c = F.lower(py_strip((F.col(x) if isinstance(x, str) else x).cast("string")))
    hit = c.isin("1", "1.0", "true", "yes", "y", "t") | (F.expr("double('1')") == c.try_cast("double"))
    return F.when(F.coalesce(hit, F.lit(False)), 1).otherwise(0)


def to_number(x: Column | str) -> Column:
    """A number, or 0 where it isn't one."""
    return F.coalesce((F.col(x) if isinstance(x, str) else x).try_cast("double"), F.lit(0.0))


def joined_flags(flags: Sequence[str], sep: str = "|") -> Column:
    """Names of the set flags in the given order."""
    return F.concat_ws(sep, *[F.when(F.col(f) == 1, F.lit(f)) for f in flags])


def count_flags(flags: Sequence[str]) -> Column:
    out = F.lit(0)
    for f in flags:
        out = out + F.coalesce(F.col(f), F.lit(0))
    return out.cast("int")


def any_flag(flags: Sequence[str]) -> Column:
    return F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in flags]) == 1


def sorted_set(x: Column, sep: str = "|") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(x)), sep)


def remap(x: Column | str, mapping: Mapping[str, str]) -> Column:
    """Stripped, then mapped where the value is a key, else itself."""
    t = py_strip(x)
    if not mapping:
        return t
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(m[t], t)


def parse_bool(x: Column | str) -> Column:
    """true / false by value or spelling; anything else null."""
    c = F.lower(F.trim((F.col(x) if isinstance(x, str) else x).cast("string")))
    return F.when(c == "true", True).when(c == "false", False)


def now_utc() -> Column:
    """When the query began, as an ISO text in UTC whatever the session's time zone."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def first_filled(*cols: Column | str) -> Column:
    """The first that is neither null nor empty."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def made_id(prefix: str, n: Column | str, width: int = 8) -> Column:
    return F.format_string(f"{prefix}%0{width}d", F.col(n) if isinstance(n, str) else n)


def fill_blank_id(df: DataFrame, id_col: str, prefix: str, ordinal: str, width: int = 8) -> DataFrame:
    c = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return df.withColumn(id_col, F.when(F.trim(c) == "", made_id(prefix, ordinal, width)).otherwise(c))


def with_alias(df: DataFrame, target: str, candidates: Sequence[str]) -> DataFrame:
    """target from the first candidate column that is present; decided on the schema, not on values."""
    if target in df.columns:
        return df
    for c in candidates:
        if c in df.columns:
            return df.withColumn(target, F.col(c))
    raise ValueError(f"none of the columns {[target, *candidates]} is present")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def padded(df: DataFrame, columns: Sequence[str], fill: str | None = None) -> DataFrame:
    """Exactly these columns in this order; absent ones filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).cast("string").alias(c) for c in columns])


def set_label(df: DataFrame, label: Column, neutral: str = "safe") -> DataFrame:
    """The label and whether it is a violation move together."""
    return df.withColumns({"final_category": label, "final_violation": label != neutral})


def output_row(df: DataFrame, label: str, text: str, source: str) -> DataFrame:
    """The default output row of a generated text; its id is a function of what it says."""
    key = F.md5(F.concat_ws("\x1f", F.col(label), normalise(text)))
    return df.select(F.concat(F.col(label), F.lit("__"), key).alias("content_id"), F.col(text).alias("text"), F.col(label).alias("llm_label"), F.lit(source).alias("source"), F.lit("synthetic").alias("origin"), F.lit("ok").alias("sample_quality"))

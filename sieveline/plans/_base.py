"""Registry of queries with their SQL, and the bindings of the driver's tables to the curation schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
FLAGS = ("f1", "f2", "f3", "f4", "f5", "f6", "f7")
LABELS = tuple(f"L{i}" for i in range(1, 9))
#: Spellings of a flag by doc_id % 9 (fixed values).
SPELLINGS = ("1", "1.0", "TRUE", "y", " t ", "2", "abc", "", None)

#: White space as Python sees it, spelled out for RE2.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


def sql_key(x: str) -> str:
    return f"lower({sql_norm(x)})"


#: posts, the split by doc_id % 3, flags from the bits of doc_id div 8, juror verdicts from its base-3 digits.
PRELUDE = f"""
posts AS (SELECT doc_id AS _ord, text AS clean_text, lang AS language, source, 'L' || CAST(doc_id % 8 + 1 AS VARCHAR) AS label,
                 {sql_key('text')} AS key FROM documents),
seen AS (SELECT * FROM posts WHERE _ord % 3 = 0),
fresh AS (SELECT * FROM posts WHERE _ord % 3 <> 0),
flagged AS (SELECT *, {', '.join(f'CAST((_ord // {4 * 2 ** i}) % 2 AS INT) AS f{i + 1}' for i in range(7))} FROM posts),
verdicts AS (
  SELECT p._ord AS content_id, j.juror,
         CASE (p._ord // j.step) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS violation,
         'L' || CAST((p._ord // j.step) % 5 + 1 AS VARCHAR) AS category,
         CAST((p._ord * j.step) % 97 AS DOUBLE) AS latency_ms
  FROM posts p, (VALUES ('A', 1), ('B', 3), ('C', 9)) AS j(juror, step))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("L"), (F.col("doc_id") % 8 + 1).cast("string"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_ord"), F.col("text").alias("clean_text"), F.col("lang").alias("language"), "source", label.alias("label"))


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where("_ord % 3 = 0")


def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where("_ord % 3 <> 0")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).withColumns({f: F.expr(f"CAST((_ord div {4 * 2**i}) % 2 AS INT)") for i, f in enumerate(FLAGS)})


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = F.explode(F.array(*[F.struct(F.lit(x).alias("juror"), F.lit(s).alias("step")) for x, s in (("A", 1), ("B", 3), ("C", 9))]))
    v = posts(spark, sf_dir).select(F.col("_ord").alias("content_id"), j.alias("j"))
    digit = F.expr("(content_id div j.step) % 3")
    return v.select(
        "content_id", "j.juror", F.when(digit == 0, True).when(digit == 1, False).alias("violation"),
        F.concat(F.lit("L"), F.expr("(content_id div j.step) % 5 + 1").cast("string")).alias("category"), F.expr("CAST((content_id * j.step) % 97 AS DOUBLE)").alias("latency_ms"),
    )


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under its function's name; sql follows the CTEs of PRELUDE."""

        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                s = sql.strip()
                rec = "RECURSIVE " if s.startswith("RECURSIVE") else ""
                s = s.removeprefix("RECURSIVE").strip()
                self.oracles[f.__name__] = f"WITH {rec}{PRELUDE}" + (f", {s[4:]}" if s.upper().startswith("WITH") else f"\n{s}")
            return f

        return add

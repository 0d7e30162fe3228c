"""Model calls as a source: a caller's function over the prompts of a table, with retries and a linear backoff.

The engine knows no service: `connect` makes a function from prompt to text, once a task (a client, a pooled connection),
and is sent to the executors with the query. What it returns, or the error it raised, is a row either way.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from .tables import delete, finished, settled

CALL_SCHEMA = "raw string, error string, attempts int, latency_ms double, total_latency_ms double"


def attempt(call: Callable[[str], str], prompt: str, max_retries: int, backoff: float, good: Callable[[str], bool] | None) -> tuple[str | None, str | None, int, float, float]:
    """(raw, error, attempts, latency_ms, total_latency_ms) of one prompt."""
    total = 0.0
    for n in range(max_retries + 1):
        began = time.monotonic()
        try:
            raw, error = call(prompt), None
        except Exception as e:  # what a service's client may raise isn't known here
            raw, error = None, f"{type(e).__name__}: {e}"[:300]
        took = (time.monotonic() - began) * 1000
        total += took
        if error is None and (good is None or good(raw)) or n == max_retries:
            break
        time.sleep(backoff * (n + 1))
    return raw, error, n + 1, took, total


def call_model(df: DataFrame, connect: Callable[[], Callable[[str], str]], id_col: str, prompt_col: str, max_retries: int = 5, backoff: float = 10.0, good: Callable[[str], bool] | None = None) -> DataFrame:
    """(id, raw, error, attempts, latency_ms, total_latency_ms): one row a row of df.

    A call that raises, or whose text isn't `good`, is made again up to max_retries times, after backoff * 1, 2, 3 ... seconds;
    the last attempt's row is kept. latency_ms is that of the last attempt, total_latency_ms of all, pauses apart. A null prompt is called
    with an empty one. Calls are made again if a task is: see logged_calls for those that cost."""
    kind = dict(df.dtypes)[id_col]

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = connect()
        for batch in batches:
            got = [attempt(call, p if isinstance(p, str) else "", max_retries, backoff, good) for p in batch[prompt_col]]
            out = pd.DataFrame(got, columns=["raw", "error", "attempts", "latency_ms", "total_latency_ms"])
            out.insert(0, id_col, batch[id_col].to_numpy())
            yield out

    return df.select(id_col, prompt_col).mapInPandas(f, f"`{id_col}` {kind}, {CALL_SCHEMA}")


LOG_SCHEMA = "key string, raw string, error string, attempts int, latency_ms double, total_latency_ms double"


def logged_calls(
    df: DataFrame, connect: Callable[[], Callable[[str], str]], id_col: str, prompt_col: str, log: str, max_retries: int = 5, backoff: float = 10.0, good: Callable[[str], bool] | None = None,
    in_flight: int = 4, version: str = "", each: int = 64,
) -> DataFrame:
    """call_model with a durable log, for calls that cost: rows as there, but a prompt is paid for once.

    The idempotency key of a call is a hash of `version` (of model and settings) and prompt: equal prompts share a call, and a
    key that the log holds is not called. A task keeps `in_flight` calls going and writes each answer to a file of its own,
    named by its key, as soon as it is there; before a call it looks for that file. So a task that runs again, or a run
    that goes on after one that died, calls only what was not answered (answers under way when a machine is lost are the
    most that can be paid twice). When a run is through, its answers become a table of the log and the files go. Errors are
    rows of the result but not of the log: the next run calls them again. Tasks hold about `each` prompts. The log's folder
    must be one that pyarrow's file systems reach from every executor; keep speculation off for the stage."""
    spark = df.sparkSession
    (k,) = unused(df, "call_key")
    rows = df.select(id_col, F.coalesce(F.col(prompt_col), F.lit("")).alias(prompt_col)).withColumn(k, F.sha2(F.concat(F.lit(f"{version}\x1f"), prompt_col).cast("binary"), 256))
    tables = finished(spark, log, _CALLS)
    known = spark.read.schema(LOG_SCHEMA).parquet(*[p for _, p in tables]) if tables else spark.createDataFrame([], LOG_SCHEMA)
    open_ = rows.select(F.col(k).alias("key"), F.col(prompt_col).alias("prompt")).join(known.where("error IS NULL").select("key"), "key", "left_anti").groupBy("key").agg(F.min("prompt").alias("prompt"))
    todo = settled(open_, "calls")
    n = todo.count()
    if n:
        parts = min(10_000, max(1, -(-n // each)))
        answers = todo.repartition(parts, "key").mapInPandas(_calls(connect, f"{log}/open", max_retries, backoff, good, in_flight), LOG_SCHEMA)
        answers.write.mode("overwrite").parquet(f"{log}/calls-{tables[-1][0] + 1 if tables else 0:010d}")
        delete(spark, f"{log}/open")  # each is in the table now
        tables = finished(spark, log, _CALLS)
    every = spark.read.schema(LOG_SCHEMA).parquet(*[p for _, p in tables]) if tables else known
    # a key may have errors of earlier runs beside its answer, or only errors
    best = every.groupBy("key").agg(F.max_by(F.struct("raw", "error", "attempts", "latency_ms", "total_latency_ms"), F.col("error").isNull()).alias("x"))
    return rows.withColumnRenamed(k, "key").join(best, "key", "left").select(id_col, "x.*")


_CALLS = re.compile(r"calls-(\d{10})$")


def _calls(connect: Callable, folder: str, max_retries: int, backoff: float, good: Callable[[str], bool] | None, in_flight: int):
    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        call = connect()

        def answer(key: str, prompt: str) -> tuple:
            path = f"{root}/{key[:2]}/{key}.json"
            if files.get_file_info(path).type != fs.FileType.NotFound:
                with files.open_input_stream(path) as s:
                    return (key, *json.loads(s.read()))
            got = attempt(call, prompt, max_retries, backoff, good)
            if got[1] is None:
                files.create_dir(f"{root}/{key[:2]}", recursive=True)
                part = f"{path}.{uuid.uuid4().hex}"
                with files.open_output_stream(part) as s:
                    s.write(json.dumps(got).encode())
                files.move(part, path)  # whole or not at all
            return (key, *got)

        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(answer, batch["key"], batch["prompt"])), columns=[x.split()[0] for x in LOG_SCHEMA.split(", ")])

    return f

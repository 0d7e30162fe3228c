"""Loops, streams and logs that keep state: against their batch forms, across replays, deaths and late rows."""

import collections
import glob
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sieveline.operators import balance, dedup, keystore, state
from sieveline.sources import providers
from sieveline.sources import tables as io
from sieveline.streaming import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fill_reads_main_once_and_goes_on(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(t):
        read.add(1)
        return t

    rows = [(i, f"text {i}", "L1" if i % 3 else "L2") for i in range(60)]
    main = spark.createDataFrame(rows, "_ord int, clean_text string, final_category string").withColumn("clean_text", F.udf(seen)("clean_text"))
    asked = []

    def ask(label, n, k):
        asked.append((label, n, k))
        return spark.createDataFrame([(i, "Text 3" if i == 0 else "" if i == 1 else f"{label} {k} {i}") for i in range(n)], "_ord int, clean_text string")

    root = f"file://{tmp_path}/fill"
    _, rounds = state.fill_to_target(main, ask, ["L1", "L2"], 50, 3, 12, root=root)
    assert (rounds, read.value) == (3, 60)
    got, rounds = state.fill_to_target(main, ask, ["L1", "L2"], 50, 30, 12, root=root)  # goes on where the first has stopped
    assert read.value == 60 and asked[3][2] == 3 and rounds == len(asked)
    per = {r[0]: r[1] for r in got.groupBy("final_category").count().collect()}
    assert per == {"L1": 50, "L2": 50}
    texts = [r[0] for r in got.select("clean_text").collect()]
    assert max(collections.Counter(t for t in texts if t).values()) == 1 and "Text 3" not in texts and got.columns == main.columns


def test_fill_after_a_death_between_rows_and_keys(spark, tmp_path, monkeypatch):
    main = spark.createDataFrame([(1, "a", "L1")], "_ord int, clean_text string, final_category string")
    ask = lambda label, n, k: spark.createDataFrame([(i, f"new {i // 2}") for i in range(n)], "_ord int, clean_text string")
    root, add = f"file://{tmp_path}/fill", keystore.KeyStore.add

    def dies(self, version, keys, at=None):
        if version == 1:
            raise KeyboardInterrupt
        add(self, version, keys, at)

    monkeypatch.setattr(keystore.KeyStore, "add", dies)
    with pytest.raises(KeyboardInterrupt):
        state.fill_to_target(main, ask, ["L1"], 9, 4, 6, root=root)
    monkeypatch.setattr(keystore.KeyStore, "add", add)
    got, rounds = state.fill_to_target(main, ask, ["L1"], 9, 4, 6, root=root)
    assert rounds == 4 and sorted(r[0] for r in got.select("clean_text").collect()) == ["a", *(f"new {i}" for i in range(3))]  # later rounds bring nothing new


def test_key_store_looks_up_buckets_only(spark, tmp_path):
    store = keystore.KeyStore(spark, f"file://{tmp_path}/keys", buckets=8, compact_every=3)
    keys = lambda xs: spark.createDataFrame([(x,) for x in xs], "x long").select(F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"), F.col("x").alias("t"))
    store.add(0, keys(range(500)), "t")
    rows = io.settled(keys([1, 499, 500]), "rows")
    left = store.unseen(rows, "h1", "h2")
    assert [r["t"] for r in left.collect()] == [500]
    text = plan(left)
    scan = next(x for x in text.splitlines() if "bucket" in x and "Scan" in x)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", scan) and "hashpartitioning(h1" not in text
    store.add(1, keys(range(500, 520)), "t")
    store.add(2, keys([5]), "t")
    assert store.unseen(io.settled(keys([505]), "rows"), "h1", "h2", 1).count() == 1  # as a replay of batch 1 sees it
    store.compact(oldest=100)
    assert [n for n, _ in store.versions()] == [2] and store.stored().count() == 420
    assert [r["t"] for r in store.unseen(io.settled(keys([5, 200, 519, 520]), "rows"), "h1", "h2").orderBy("t").collect()] == [5, 520]


def brute(bad, run):
    n = 0
    for i, b in enumerate(bad):
        n = n + 1 if b else 0
        if n == run:
            return i - run + 1
    return len(bad)


@pytest.mark.parametrize("seed", range(4))
def test_breaker_drops_the_run(spark, seed):
    r = random.Random(seed)
    bad = [r.random() < 0.5 for _ in range(120)] if seed else [False] * 30
    df = spark.createDataFrame([(i, b if b or i % 2 else None) for i, b in enumerate(bad)], "_ord int, b boolean").repartition(5)
    for run in (1, 4, 9):
        assert sorted(x["_ord"] for x in dedup.until_failures(df, F.col("b"), run).collect()) == [*range(brute(bad, run))]
    assert dedup.until_failures(df.limit(0), F.col("b"), 2).count() == 0


@pytest.mark.parametrize(("bad", "run"), [("0001111000", 4), ("0011011100", 3), ("00110110", 3), ("1111", 2), ("0111", 5)])
def test_breaker_stream_equals_batch(spark, tmp_path, bad, run):
    """Files of two rows, so that runs go over the ends of batches."""
    rows, root = [(i, c == "1") for i, c in enumerate(bad)], f"file://{tmp_path}"
    for k in range(0, len(rows), 2):
        io.append_log(spark.createDataFrame(rows[k : k + 2], "_ord int, b boolean").coalesce(1), f"{root}/log")
        time.sleep(0.05)
    want = [*range(brute([b for _, b in rows], run))]
    for _ in range(2):  # and again, after it has ended
        log = jobs.read_log(spark, f"{root}/log", "_ord int, b boolean", 1)
        got, tripped = jobs.breaker_rows(jobs.breaker_stream(log, F.col("b"), run, "_ord", root), spark, root)
        assert sorted(r["_ord"] for r in got.collect()) == want and tripped == (len(want) < len(rows))


def test_rebuild_stream_with_late_and_repeated_rows(spark, tmp_path):
    root = f"file://{tmp_path}"
    files = [
        [(2, "b", 100), (1, "a", 100), (3, "A ", 101), (4, "no", 102), (5, None, 100)],
        [(6, "a", 110), (7, "c", 111), (8, "c", 105)],
        [(9, "d", 200), (10, "b", 109), (11, "e", None)],  # b is repeated within the delay
        [(12, "f", 120), (13, "d", 199)],  # f comes more than a minute late
        [(14, "e", 500), (15, "g", 500)],
    ]
    for rows in files:
        io.append_log(spark.createDataFrame(rows, "_ord int, t string, at int").withColumn("at", F.timestamp_seconds("at")).coalesce(1), f"{root}/log")
        time.sleep(0.05)
    valid = lambda r: r.where("t <> 'no'")
    for _ in range(2):
        log = jobs.read_log(spark, f"{root}/log", "_ord int, t string, at timestamp", 1)
        jobs.rebuild_stream(log, valid, "t", "_ord", "at", 60, root).awaitTermination()
        assert sorted(r["_ord"] for r in jobs.sunk(spark, root).collect()) == [1, 2, 7, 9, 11, 15]
    assert len(glob.glob(f"{tmp_path}/time/batch-*")) == 2  # the state's older versions are gone


def test_rebuild_state_follows_the_delay(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    monkeypatch.setattr(jobs, "KeyStore", lambda s, r: keystore.KeyStore(s, r, buckets=4, compact_every=2))
    for k in range(6):
        io.append_log(spark.createDataFrame([(10 * k + i, f"t{k} {i}", 1000 * k) for i in range(10)], "_ord int, t string, at int").withColumn("at", F.timestamp_seconds("at")).coalesce(1), f"{root}/log")
        time.sleep(0.05)
    log = jobs.read_log(spark, f"{root}/log", "_ord int, t string, at timestamp", 1)
    jobs.rebuild_stream(log, lambda r: r, "t", "_ord", "at", 1500, root).awaitTermination()
    assert jobs.sunk(spark, root).count() == 60 and keystore.KeyStore(spark, f"{root}/keys").stored().count() <= 30


def test_distinct_stream_keeps_no_text_in_its_state(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "t string, at int").withColumn("at", F.timestamp_seconds("at")).write.parquet(f"{tmp_path}/log")
    df = jobs.distinct_stream(jobs.read_log(spark, f"{tmp_path}/log", "t string, at timestamp"), "t", "at", "1 hour")
    text = df._jdf.queryExecution().analyzed().toString()
    assert re.search(r"DeduplicateWithinWatermark \[h1#\d+L, h2#\d+L\]", text)


def test_calls_are_paid_for_once(spark, tmp_path):
    """A worker dies half-way; what it was answered isn't called again."""
    (tmp_path / "paid").mkdir()
    bomb = tmp_path / "bomb"
    bomb.touch()
    paid, fuse = str(tmp_path / "paid"), str(bomb)

    def connect():
        import os
        import uuid

        def call(prompt):
            if os.path.exists(fuse) and len(os.listdir(paid)) >= 5:
                os._exit(1)
            open(f"{paid}/{prompt}.{uuid.uuid4().hex}", "w").close()
            if prompt == "p7":
                raise OSError("no answer")
            return prompt.upper()

        return call

    df = spark.createDataFrame([(i, f"p{i % 12}") for i in range(40)] + [(99, None)], "id int, prompt string").repartition(3)
    log = f"file://{tmp_path}/log"
    with pytest.raises(Exception, match="(?i)python worker|exited|failure"):
        providers.logged_calls(df, connect, "id", "prompt", log, 0, 0.0, in_flight=1, each=100)
    assert len(list((tmp_path / "paid").iterdir())) == 5
    bomb.unlink()
    got = {r["id"]: (r["raw"], r["error"]) for r in providers.logged_calls(df, connect, "id", "prompt", log, 0, 0.0, in_flight=3, each=4).collect()}
    assert got == {i: (None, "OSError: no answer") if i % 12 == 7 else (f"P{i % 12}", None) for i in range(40)} | {99: ("", None)}
    count = collections.Counter(p.name.split(".")[0] for p in (tmp_path / "paid").iterdir())
    assert {k: n for k, n in count.items() if k != "p7"} == {f"p{i}": 1 for i in range(12) if i != 7} | {"": 1}
    assert not (tmp_path / "log" / "open").exists()
    again = providers.logged_calls(df, connect, "id", "prompt", log, 0, 0.0)
    assert again.count() == 41
    after = collections.Counter(p.name.split(".")[0] for p in (tmp_path / "paid").iterdir())
    assert after - count == {"p7": 1}  # an error is tried again, an answer isn't
    providers.logged_calls(df.limit(1), connect, "id", "prompt", log, 0, 0.0, version="other")
    assert len(list((tmp_path / "paid").iterdir())) == sum(after.values()) + 1
    assert providers.logged_calls(df.limit(0), connect, "id", "prompt", log).count() == 0


def test_samples_are_the_first_by_lot(spark):
    rows = [(i, f"k{i % 700}") for i in range(2000)] + [(5000, None), (5001, None)]
    df = spark.createDataFrame(rows, "_ord int, k string").withColumn("lot", F.lit("x")).repartition(5)
    lot = F.md5(F.concat(F.col("k"), F.lit("|42")))
    order = [r["_ord"] for r in df.orderBy(lot, "_ord").collect()]
    for n in (0, 1, 2, 3, 200, 1999, 2002, 5000):
        got = balance.sample_up_to(df, n, F.col("k"))
        assert sorted(r["_ord"] for r in got.collect()) == sorted(order[:n]) and got.columns == df.columns
    text = plan(balance.sample_up_to(df, 400, F.col("k")))  # what is gathered is the rest of one group of lots, not the sample
    assert [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", text)] < [60]


def test_checkpoint_under_a_reader(spark, tmp_path):
    """A frame that was returned before a compaction can still be read after it; older generations go."""
    path = f"file://{tmp_path}/c"
    put = lambda k: io.upsert(spark, path, spark.createDataFrame([(k, k)], "id int, n int"), "id", "n", compact_every=3)
    frames = [put(k) for k in range(3)]
    put(3)
    assert [f.count() for f in frames] == [1, 2, 3]
    last = [put(k) for k in range(4, 12)]
    assert last[-1].count() == 12 and io.read_checkpoint(spark, path, "id", "n").count() == 12
    assert len(glob.glob(f"{tmp_path}/c/base-*")) == 2


def test_plans_move_no_text_where_keys_decide(spark):
    from sieveline.plans import core

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = core.QUERIES["flagship_need"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = [x for x in text.splitlines() if re.search(r"Aggregate|Join", x)]
    assert above and not any("clean_text" in x or "text#" in x for x in above)


@pytest.mark.parametrize("kind", ["int", "double", "timestamp", "string"])
def test_first_of_label_is_exact(spark, kind):
    r = random.Random(4)
    rows = [(i, r.choice("aaab"), r.choice([5, r.randrange(50), r.randrange(10**6)])) for i in range(4000)] + [(5000, "c", 1), (5001, None, 2), (5002, "zz", 3)]
    o = {"timestamp": F.timestamp_seconds("o"), "string": F.format_string("%09d", "o")}.get(kind, F.col("o").cast(kind))
    df = spark.createDataFrame(rows, "i int, label string, o int").withColumn("_ord", o).withColumns({"need": F.lit(1), "cut": F.lit("x")}).repartition(4)
    for needs in ({"a": 700, "b": 1, "c": 9, "absent": 3}, {"a": 2999, "b": 0, "c": 1}, {"a": 1, "b": 990}):
        cfg = spark.createDataFrame([*needs.items()], "label string, need int")
        got = balance.first_of_label(df, cfg, "label", 3000).collect()
        for x, n in needs.items():
            want = sorted(v for _, lab, v in rows if lab == x)[:n]
            mine = [g for g in got if g["label"] == x]
            assert sorted(g["o"] for g in mine) == want and len({g["i"] for g in mine}) == len(want)
        assert {g["label"] for g in got} <= set(needs)


def test_first_of_label_ranks_no_rows(spark):
    """Rows meet a filter; a window sees only the cut-off's ties."""
    df = spark.range(5000).select(F.col("id").alias("_ord"), F.concat(F.lit("L"), (F.col("id") % 3).cast("string")).alias("label"), F.lit("text").alias("t"))
    cfg = spark.createDataFrame([("L0", 100), ("L1", 900)], "label string, need int")
    got = balance.first_of_label(df, cfg, "label", 900)
    assert got.count() == 1000 and sorted(r["_ord"] for r in got.where("label = 'L1'").collect()) == [3 * k + 1 for k in range(900)]
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    whole, ties = ("\n".join(x for x in lines[1:] if x.startswith(":") == first) for first in (True, False))
    assert "Window" not in whole and "cut#" in whole and re.search(r"Join Inner, .*_ord#\d+L = cut#", ties)
    assert balance.first_of_label(df.withColumn("_ord", F.when(F.col("_ord") != 3, F.col("_ord"))), cfg, "label", 900).where("_ord IS NULL").count() == 1


def test_no_single_task_writes_the_log_of_a_stream(spark, tmp_path, monkeypatch):
    """Tables of four files each, whose order is not that of the ids; the streams give what the batch forms give."""
    from sieveline.plans import analysis, core

    text = F.concat(F.lit("a text of more than forty signs, by number: "), (F.col("id") % 30).cast("string"))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    value = F.when(F.expr("id BETWEEN 100 AND 107 OR id BETWEEN 445 AND 455"), 1.0).otherwise(50.0)  # the long run goes over a third append's start
    events = spark.range(600).select(F.col("id").alias("event_id"), F.col("id").cast("string").alias("event_type"), value.alias("value"))
    for name, df in (("documents", docs), ("events", events)):
        df.repartition(4).write.parquet(f"file://{tmp_path}/{name}.parquet")
    monkeypatch.setattr(io, "append_log", lambda df, path, f=io.append_log: (tasks.append(df.rdd.getNumPartitions()), f(df, path)))
    old = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 16 << 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16 << 10)  # a file a task
    try:
        got, q = {}, analysis.QUERIES | core.QUERIES
        for name, parts in (("n9_rebuild_stream", 3), ("g6_breaker_stream", 3), ("n2_stream_checkpoint", 2)):
            tasks = []
            got[name] = sorted(tuple(r) for r in q[name](spark, f"file://{tmp_path}").collect())
            assert len(tasks) >= parts and min(tasks) == 4
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[1])
    assert got["n9_rebuild_stream"] == sorted(tuple(r) for r in q["n9_rebuild_final"](spark, f"file://{tmp_path}").collect()) != []
    assert [i for i, _ in got["g6_breaker_stream"]] == [*range(445)]
    assert got["n2_stream_checkpoint"] == [(i, 300 + i, str(300 + i)) for i in range(300)]

"""Edge rows that the driver's tables don't hold."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from sieveline.functions import flags as fl
from sieveline.functions import text as tx
from sieveline.operators import balance, dedup, merge, parse, rules, state, vote
from sieveline.sources import tables as io


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize("raw", ["a   b", "\t a b\n", " a b ", "a\x1cb", "a b", "a\x0bb", "", "  ", "a​b"])
def test_normalise_is_pythons(spark, raw):
    assert one(spark, tx.normalise("x"), raw) == " ".join(raw.split())


def test_keys_of_null(spark):
    assert one(spark, tx.lower_key("x"), None) == "" and one(spark, tx.is_blank("x"), None) is True


@pytest.mark.parametrize(("raw", "want"), [("1", 1), ("1.0", 1), ("TRUE", 1), ("y", 1), (" t ", 1), ("yes", 1), ("2", 0), ("abc", 0), ("", 0), (None, 0), ("1e0", 1)])
def test_to_binary(spark, raw, want):
    assert one(spark, fl.to_binary("x"), raw) == want


def test_accents_fold(spark):
    assert one(spark, tx.matches_any("x", ["facção"]), "A FACÇÃO") is True


def test_merge_origins(spark):
    train = spark.createDataFrame([("a b", "L1", "s1", 1), ("a  b", "L2", "s2", 2), ("t", "L3", "s", 3), ("", "L4", "s", 4)], "text string, label_name string, source string, _ord int")
    new = spark.createDataFrame([("a b", 1, 1), ("once", 0, 2), ("twice", 0, 3), ("twice ", 1, 4), (None, 1, 5)], "text string, f1 int, _ord int")
    got = {r["text"]: (r["label_name"], r["f1"], r["origin"]) for r in merge.merge_schemas(train, new, ["f1"]).collect()}
    assert got == {"a b": ("L2", 1, "both"), "t": ("L3", 0, "train_only"), "": ("L4", 1, "both"), "once": ("", 0, "new_only"), "twice": ("", 1, "both")}


def reference_vote(vs):
    y, n, u = (sum(v is x for v in vs) for x in (True, False, None))
    if u >= 2:
        return None, "all_null", True
    if 3 in (y, n):
        return y == 3, "unanimous", False
    if 2 in (y, n):
        return y == 2, "majority", False
    return None, "split", True


def test_all_votes(spark):
    combos = list(itertools.product([True, False, None], repeat=3))
    rows = [(i, j, v, "L1") for i, vs in enumerate(combos) for j, v in zip("ABC", vs, strict=True)]
    df = spark.createDataFrame(rows, "content_id int, juror string, violation boolean, category string")
    got = {r["content_id"]: r for r in vote.majority_vote(df, vote.Profile({"L1": 1})).collect()}
    for i, vs in enumerate(combos):
        r = got[i]
        assert (r["final_violation"], r["vote_method"], r["requires_review"]) == reference_vote(vs)
        assert r["true_violation_count"] == sum(v is True for v in vs)


def test_category_is_by_priority_then_first_juror(spark):
    df = spark.createDataFrame([(1, "A", True, "L2"), (1, "B", True, "L3"), (1, "C", True, "L3"), (2, "A", True, "L3"), (2, "B", True, "L4"), (2, "C", False, "L2")], "content_id int, juror string, violation boolean, category string")
    got = {r[0]: r["final_category"] for r in vote.majority_vote(df, vote.Profile({"L2": 9, "L3": 1, "L4": 1})).collect()}
    assert got == {1: "L2", 2: "L3"}


@pytest.mark.parametrize(("raw", "violation", "error"), [
    ('{"violation": true, "category": "L1"}', True, None),
    ('```json\n{"violation": false, "category": "L1"}\n```', False, None),
    ('I say {"violation": true, "x": {"y": 1}, "category": "L1"} and more }', True, None),
    ('{"violation": true, "category": "L1"', True, None),
    ('{"violation": true, "category": "L1",}', True, None),
    ('{"violation": "true", "category": "L1"}', None, None),
    ("[1, 2]", None, "JSON parse error"), ("7", None, "JSON parse error"), ("", None, "JSON parse error"), (None, None, "JSON parse error"),
])
def test_verdict_parsing(spark, raw, violation, error):
    r = parse.verdicts(spark.createDataFrame([(raw,)], "raw string")).first()
    assert (r["violation"], (r["error"] or "").split(":")[0]) == (violation, error or "")


def test_verdict_fields_and_plan(spark):
    profile = vote.Profile({"L1": 2, "L2": 1})
    raws = [
        'well {"violation": true, "category": " L1 ", "confidence": 0.7, "usable": "yes", "label_match": true, "risk_level": "high", "audit_action": "review", "reason_code": "r7", "x": "{}"} end',
        '{"violation": false, "category": "L2", "confirmed_label": "L1"}', '{"violation": true, "category": "none"}', '{"violation": true, "category": "L9"}', '{"category": "L1"}', "{ {", None,
    ]
    df = parse.verdicts(spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string"), profile=profile)
    got = {r["id"]: r for r in df.collect()}
    assert got[0][2:] == (True, "L1", "L1", 0.7, "", "yes", "true", "high", "review", "r7", None)
    assert got[1][2:5] == (False, "safe", "L1") and got[2][2:5] == (False, "safe", "safe")
    assert got[3][2:4] == (None, "safe") and got[3]["error"] == "Invalid category from model: L9"
    assert got[4][2:4] == (None, "L1") and got[4]["error"] == "Missing or invalid violation field from model"
    for i in (5, 6):
        assert got[i][2:4] == (None, "safe") and got[i]["error"].startswith("JSON parse error") and got[i]["reasoning"] == f"Failed to parse JSON response after 3 attempts. Raw: {raws[i] or ''}"
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_model_calls_are_retried(spark):
    from sieveline.sources import providers

    def connect():
        seen = {}

        def call(prompt):
            seen[prompt] = seen.get(prompt, 0) + 1
            if prompt == "never" or seen[prompt] < 3 and prompt == "third":
                raise OSError("down")
            return prompt.upper() if prompt != "poor" or seen[prompt] > 1 else ""

        return call

    df = spark.createDataFrame([(1, "a"), (2, "third"), (3, "never"), (4, "poor"), (5, None)], "id int, prompt string").coalesce(1)
    got = {r["id"]: (r["raw"], r["error"], r["attempts"]) for r in providers.call_model(df, connect, "id", "prompt", 3, 0.0, bool).collect()}
    assert got == {1: ("A", None, 1), 2: ("THIRD", None, 3), 3: (None, "OSError: down", 4), 4: ("POOR", None, 2), 5: ("", None, 4)}


def test_fill_to_target(spark):
    main = spark.createDataFrame([(1, "a", "L1")], "_ord int, clean_text string, final_category string")
    asked = []

    def ask(label, n, k):
        asked.append((label, n))
        return spark.createDataFrame([(i, f"{label} {k} {i // 2}") for i in range(n)], "_ord int, clean_text string")

    got, rounds = state.fill_to_target(main, ask, ["L1", "L2"], 7, 20, 10)
    assert {(r[0], r[1]) for r in got.groupBy("final_category").count().collect()} == {("L1", 7), ("L2", 7)}
    assert asked[:2] == [("L2", 7), ("L1", 6)] and rounds == len(asked)
    assert state.fill_to_target(main, ask, ["L1", "L2"], 7, 1, 10)[1] == 1


def test_now_is_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        import datetime

        at = datetime.datetime.fromisoformat(spark.range(1).select(fl.now_utc()).first()[0])
        assert abs((datetime.datetime.now(datetime.UTC) - at).total_seconds()) < 600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_records(spark):
    size = F.when(parse.records(F.col("x")).isNotNull(), F.size(parse.records(F.col("x"))))
    for raw, want in (("[1, 2]", 2), ('{"a": 1},\n{"a": 2}', 2), ('{"a": 1}\nbad', None), ("```jsonl\n1\n2\n3\n```", 3), (None, None)):
        assert one(spark, size, raw) == want


def test_duplicate_reasons_in_order(spark):
    df = spark.createDataFrame([(1, "o"), (2, "o"), (3, "s"), (4, "n")], "_ord int, key string")
    o, s = spark.createDataFrame([("o",)], "key string"), spark.createDataFrame([("s",), ("o",)], "key string")
    assert {r["_ord"]: r["reason"] for r in dedup.classify_duplicates(df, o, s).collect()} == {1: "original", 2: "in_batch", 3: "synthetic", 4: "accepted"}


def test_exclude_keeps_blank(spark):
    df, seen = spark.createDataFrame([("",), ("A",), ("b",), (None,)], "t string"), spark.createDataFrame([("a ",), ("",)], "t string")
    assert sorted(str(r[0]) for r in dedup.exclude(df, seen, "t").collect()) == ["", "None", "b"]


@pytest.mark.parametrize("bad", [[0, 1, 1, 1, 1, 0], [1, 1, 1, 1, 1, 0], [0, 1, 1, 1, 1, 1, 1], [1, 1, 1, 1, 0, 1, 1, 1, 1]])
def test_run_of_five(spark, bad):
    df = spark.createDataFrame(list(enumerate(bad)), "_ord int, b int")
    want = next((i for i in range(len(bad)) if i >= 4 and all(bad[i - 4 : i + 1])), None)
    assert dedup.first_failures(df, F.col("b") == 1, 5).first()[0] == want


def simulate(main, pools, labels, target):
    seen, have, out = {t.strip() for t, _ in main}, {x: sum(1 for _, y in main if y == x) for x in labels}, []
    for name, pool in pools:
        best = {}
        for i, t, x in pool:
            if x in labels and t.strip() and t.strip() not in seen:
                best.setdefault(t.strip(), (i, x))
        for k, (i, x) in sorted(best.items(), key=lambda kv: kv[1][0]):
            if have[x] < target:
                have[x] += 1
                seen.add(k)
                out.append((i, name))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_balance_against_simulation(spark, seed):
    r = random.Random(seed)
    text = lambda: r.choice(["a", "b", "c ", " c", "d", "e", "f", "g", "", "h", "i"])
    main = [(text(), r.choice(["L1", "L2"])) for _ in range(3)]
    pools = [(n, [(k * 100 + i, text(), r.choice(["L1", "L2", "L3", "X"])) for i in range(12)]) for k, n in enumerate(("p", "q", "r"))]
    df = lambda rows: spark.createDataFrame(rows, "_ord int, clean_text string, final_category string")
    got = balance.balance(df([(-i, t, x) for i, (t, x) in enumerate(main)]), [(n, df(p)) for n, p in pools], ["L1", "L2", "L3"], 3)
    assert sorted((x["_ord"], x["balance_source"]) for x in got.collect()) == simulate(main, pools, ["L1", "L2", "L3"], 3)


def test_quota_keeps_duplicates_within_a_label(spark):
    df = spark.createDataFrame([(1, "a", 1, 1), (2, "a", 1, 0), (3, "b", 0, 1)], "_ord int, t string, f1 int, f2 int")
    got = balance.quota_select(df, [("T1", ["f1"], 0, 999.0), ("T2", ["f2"], 5, 2.0)], "t", ["f1", "f2"])
    assert sorted((r["_ord"], r["target_label"]) for r in got.collect()) == [(1, "T1"), (2, "T1"), (3, "T2")]


def test_first_rule_decides(spark):
    rs = [rules.Rule("L1", "drop", "one", all_of=("x",)), rules.Rule("L1", "relabel", "two", "L2", all_of=("y",))]
    df = spark.createDataFrame([(1, "L1", "x y"), (2, "L1", "Y"), (3, "L3", "x"), (4, None, None)], "_ord int, final_category string, t string")
    clean, actions = rules.apply_rules(df, rules.decide(F.col("final_category"), F.col("t"), rs))
    assert {r["_ord"]: r["final_category"] for r in clean.collect()} == {2: "L2", 3: "L3", 4: None}
    assert {r["_ord"]: (r["reason"], r["new_label"]) for r in actions.collect()}[1] == ("one", "")


def test_csv_round_trip_and_bom(spark, tmp_path):
    rows = [("1", 'he said "x,\ny"'), ("2", None), ("3", "NA"), ("4", " a ")]
    df = spark.createDataFrame(rows, "id string, t string")
    io.write_csv(df, f"file://{tmp_path}/c")
    assert sorted(map(tuple, io.read_csv(spark, f"file://{tmp_path}/c").collect())) == rows
    assert dict(map(tuple, io.read_csv_strict_strings(spark, f"file://{tmp_path}/c").collect()))["2"] == ""
    assert dict(map(tuple, io.read_csv_inferred(spark, f"file://{tmp_path}/c", {"id": "int"}).collect()))[3] is None
    io.export_csv_with_bom(df, f"file://{tmp_path}/b", ["id", "t"])
    assert next((tmp_path / "b").glob("part-*")).read_bytes()[:3] == b"\xef\xbb\xbf"
    assert io.read_csv(spark, f"file://{tmp_path}/b").columns == ["id", "t"]


def test_strict_and_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_required(spark, f"file://{tmp_path}/none", ["a"])
    spark.range(1).write.parquet(f"file://{tmp_path}/p")
    with pytest.raises(ValueError, match="lacks"):
        io.read_required(spark, f"file://{tmp_path}/p", ["a"])
    assert io.read_or_empty(spark, f"file://{tmp_path}/none", ["a"]).count() == 0


def test_upsert_unions_schemas(spark, tmp_path):
    path = f"file://{tmp_path}/u"
    io.upsert(spark, path, spark.createDataFrame([("1", "x", 1), ("2", "y", 2)], "id string, a string, o int"), "id", "o")
    got = io.upsert(spark, path, spark.createDataFrame([("1", "err", 3)], "id string, e string, o int"), "id", "o")
    assert {r["id"]: (r["a"], r["e"]) for r in got.collect()} == {"1": (None, "err"), "2": ("y", None)}


def test_upsert_survives_a_death_between_its_steps(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/u"
    row = lambda *rows: spark.createDataFrame(list(rows), "id string, a string, o int")
    state_now = lambda: sorted((r["id"], r["a"]) for r in io.read_checkpoint(spark, path, "id", "o").collect())
    assert io.read_checkpoint(spark, path, "id", "o") is None
    io.upsert(spark, path, row(("1", "x", 1)), "id", "o", compact_every=3)
    io.upsert(spark, path, row(("2", "y", 2)), "id", "o", compact_every=3)
    # a writer that died while it wrote a delta, and one that died with the new base there but the old versions not yet gone
    (tmp_path / "u/delta-0000000003").mkdir()
    (tmp_path / "u/delta-0000000003/part-0.parquet").write_bytes(b"half")
    assert state_now() == [("1", "x"), ("2", "y")]

    class Dead(Exception):
        pass

    real = io._file_system

    def dying(spark, p):
        fs, at = real(spark, p)

        class Fs:
            def __getattr__(self, name):
                if name == "delete":
                    raise Dead
                return getattr(fs, name)

        return Fs(), at

    monkeypatch.setattr(io, "_file_system", dying)
    with pytest.raises(Dead):
        io.upsert(spark, path, row(("1", "z", 3)), "id", "o", compact_every=3, retain=0)  # nothing kept for readers, so that it deletes
    monkeypatch.undo()
    assert state_now() == [("1", "z"), ("2", "y")]
    io.upsert(spark, path, row(("3", "w", 4)), "id", "o", compact_every=3)
    assert state_now() == [("1", "z"), ("2", "y"), ("3", "w")]


def test_dedup_plans_have_no_texts_as_keys(spark, tmp_path):
    """Exchanges and sorts are by long integers (L), whatever else they carry."""
    import re

    df = spark.createDataFrame([(i, "text %d" % (i % 3), "s") for i in range(9)], "_ord long, clean_text string, source string")
    df.write.parquet(f"file://{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.read.parquet(f"file://{tmp_path}/t")
        k = tx.lower_key("clean_text")
        marked = dedup.classify_duplicates(t.withColumn("key", k), t.withColumn("key", k), t.withColumn("key", k))
        for q in (dedup.keep_first(t, k), dedup.keep_last(t, k), dedup.exclude(t, t, "clean_text"), marked, dedup.duplicate_count(t, k)):
            plan = q._jdf.queryExecution().executedPlan().toString()
            keys = re.findall(r"hashpartitioning\(([^)]*?), \d+\)|Sort \[([^\]]*)\]", plan)
            assert keys and all(re.fullmatch(r"(\w+#\d+L( ASC NULLS FIRST)?(, )?)+", a or b) for a, b in keys), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_that_are_null_or_tie(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (None, "k", "c"), (3, "k", "d"), (4, "t", "e"), (4, "t", "f"), (None, "n", "g")], "_ord int, key string, h1 string")
    first = {(r["_ord"], r["h1"]) for r in dedup.keep_first(df, F.col("key")).collect()}
    assert {(1, "a"), (3, "d"), (None, "g")} < first and len(first) == 4
    assert {(2, "b"), (3, "d"), (None, "g")} < {(r["_ord"], r["h1"]) for r in dedup.keep_last(df, F.col("key")).collect()}
    got = [r["reason"] for r in dedup.classify_duplicates(df.where("_ord < 4"), df.where("key IS NULL"), df.limit(0)).orderBy("_ord").collect()]
    assert got == ["original", "in_batch", "accepted"]


def test_rank_first_of_a_large_cap_leaves_the_session_alone(spark):
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    df = spark.range(5000).select(F.col("id").alias("_ord"), F.lit(1).alias("f1"))
    assert dedup.cap_per_flag(df, ["f1"], 2000).agg(F.max("_ord"), F.count("*")).first()[:] == (1999, 2000)
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == before


def test_promotion_from_overflow(spark):
    main = spark.createDataFrame([(0, "m", "L1")], "_ord int, clean_text string, final_category string")
    over = spark.createDataFrame([(1, "a", "L1"), (2, "a ", "L1"), (3, "b", "L1"), (4, "c", "L1"), (5, "d", "L2"), (6, "e", "L3")], "_ord int, clean_text string, final_category string")
    new, rest = balance.promote(main, over, {"L1": 2, "L2": 5}, "final_category", "clean_text")
    assert sorted(r[0] for r in new.collect()) == [0, 1, 3, 5] and sorted(r[0] for r in rest.collect()) == [4, 6]


def test_status_and_next_label(spark):
    r = spark.createDataFrame([("a", 10, 0, 0, 0, 0), ("b", 5, 5, 0, 0, 0), ("c", 5, 1, 3, 0, 0), ("d", 5, 1, 0, 1, 0), ("e", 5, 1, 0, 1, 4)], "label string, original_unique_count int, accepted_main_count int, retry_count int, parse_error_count int, generated_request_count int")
    assert [x["status"] for x in state.run_status(r, 10, 3).orderBy("label").collect()] == ["already_enough", "completed", "not_enough_after_retry", "failed_parse", "error"]
    g = spark.createDataFrame([("a", 2), ("b", 2), ("c", 0)], "label string, gap int")
    assert tuple(state.next_label(g, "label", "gap", ["b", "a", "c"], 30).first()) == ("b", 2, 5)


def test_entry_without_the_llm_subpackage(tmp_path):
    """A copy without sieveline/llm and the pipeline still gives every other query."""
    import pathlib
    import shutil
    import subprocess
    import sys

    here = pathlib.Path(__file__).resolve().parent.parent
    shutil.copytree(here / "sieveline", tmp_path / "sieveline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={**__import__("os").environ, "PYTHONPATH": str(tmp_path)})
    names, sql = json.loads(done.stdout)
    assert "flagship_need" in names and len(names) > 140 and set(sql) <= set(names) and not [n for n in names if n.startswith("op") or n == "pipeline"]
    assert "without sieveline.llm.queries" in done.stderr


def test_stream_keeps_one_row_a_key(spark, tmp_path):
    from sieveline.streaming import jobs

    rows = [("a b", "2024-01-01 00:00:00"), ("A  b", "2024-01-01 00:01:00"), ("c", "2024-01-01 00:02:00")]
    spark.createDataFrame(rows, "t string, ts string").select("t", F.to_timestamp("ts").alias("ts")).write.parquet(f"file://{tmp_path}/log")
    log = jobs.read_log(spark, f"file://{tmp_path}/log", "t string, ts timestamp")
    out = jobs.distinct_stream(log, "t", "ts", "1 hour").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    out.awaitTermination()
    assert sorted(tx for (tx,) in spark.sql("SELECT lower(replace(t, '  ', ' ')) FROM once").collect()) == ["a b", "c"]


def test_crosstab_has_a_row_for_every_source(spark, tmp_path):
    from sieveline.plans import analysis

    rows = [(i, f"text {i}", "en", s, 6) for i, s in enumerate(["src0", "src0", "blog", "src25", None])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    total = {r["source"]: r["n"] for r in analysis.QUERIES["f9_crosstab"](spark, str(tmp_path)).collect() if r["label"] == "All"}
    assert total == {"src0": 2, "blog": 1, "src25": 1, None: 1, "All": 5}


def test_crosstab_has_a_zero_for_every_pair_that_does_not_occur(spark):
    from sieveline.operators import merge

    df = spark.createDataFrame([("L1", "a"), ("L1", "a"), ("L2", None), (None, "b")], "label string, source string")
    got = {(r["label"], r["source"]): r["n"] for r in merge.crosstab_long(df, "label", "source").collect()}
    labels, sources = ["L1", "L2", None], ["a", "b", None]
    want = {(x, y): 0 for x in [*labels, "All"] for y in [*sources, "All"]}
    want |= {("L1", "a"): 2, ("L2", None): 1, (None, "b"): 1, ("L1", "All"): 2, ("L2", "All"): 1, (None, "All"): 1, ("All", "a"): 2, ("All", "b"): 1, ("All", None): 1, ("All", "All"): 4}
    assert got == want

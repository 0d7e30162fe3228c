"""The keyed merge as a bucketed corpus, and long keyword lists, against plain forms; their plans."""

import random
import re
import time

from pyspark.sql import functions as F

from sieveline.functions import text as tx
from sieveline.operators import keywords, merge, parse, rules

TRAIN = "lang string, text string, label_name string, source string, _ord long"
NEW = "lang string, text string, f1 int, f2 int, _ord long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus_rows(seed, n=120):
    r = random.Random(seed)
    texts = [f"text  {i} " for i in range(25)] + ["", None, "É \t b"]
    train = [(r.choice(["x", "y", None]), r.choice(texts), r.choice(["L1", " L2 ", None]), r.choice(["s", None]), i) for i in range(n)]
    new = [(r.choice(["x", "y", None]), r.choice(texts), r.randint(0, 1), r.randint(0, 1), i) for i in range(n)]
    return train, new


def plain_merge(train, new):
    """{(group, text): row} by a loop over the rows in order."""
    norm = lambda t: " ".join((t or "").split())
    out = {}
    for g, t, label, source, _ in sorted(train, key=lambda r: r[4]):
        out[g, norm(t)] = [(label or "").strip(), (source or "").strip(), 0, 0, "train_only"]
    for g, t, f1, f2, _ in sorted(new, key=lambda r: r[4]):
        at = out.get((g, norm(t)))
        if at is None:
            out[g, norm(t)] = ["", "", f1, f2, "new_only"]
        else:
            at[2:] = [max(at[2], f1), max(at[3], f2), "both"]
    return {k: tuple(v) for k, v in out.items()}


def as_dict(df):
    rows = df.collect()
    out = {(r["lang"], r["text"]): (r["label_name"], r["train_source"], r["f1"], r["f2"], r["origin"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_merge_and_batches_equal_a_plain_loop(spark, tmp_path):
    train, new = corpus_rows(1)
    t, n = spark.createDataFrame(train, TRAIN), spark.createDataFrame(new, NEW)
    want = plain_merge(train, new)
    assert as_dict(merge.merge_schemas(t, n, ["f1", "f2"], ["lang"])) == want
    corpus = merge.KeyedCorpus(spark, f"file://{tmp_path}/c", ["f1", "f2"], ["lang"], buckets=8)
    assert corpus.states() is None
    # batches in no order of the rows: what counts is their own order
    corpus.absorb(1, t.where("_ord % 3 = 2"), n.where("_ord % 2 = 1"))
    corpus.absorb(2, None, n.where("_ord % 4 = 0"))
    corpus.absorb(3, t.where("_ord % 3 < 2"), n.where("_ord % 4 = 2"))
    corpus.absorb(3, t, n)  # runs again
    corpus.absorb(4, t.limit(0), n.limit(0))
    assert as_dict(corpus.view()) == want
    assert [v for v, _ in corpus.versions()] == [3, 4]


def test_batches_do_not_shuffle_the_corpus(spark, tmp_path):
    train, new = corpus_rows(2)
    t, n = spark.createDataFrame(train, TRAIN), spark.createDataFrame(new, NEW)
    corpus = merge.KeyedCorpus(spark, f"file://{tmp_path}/c", ["f1", "f2"], ["lang"], buckets=8)
    corpus.absorb(1, t, n)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(corpus.grown(None, n.limit(7)))
        before = p[: p.index("FileScan")].splitlines()
        assert "Bucketed: true" in p and "SelectedBucketsCount: 8 out of 8" in p, p
        depth = lambda line: len(re.match(r"[ :+\-]*", line)[0])
        scan = p[: p.index("FileScan")].splitlines()[-1]
        above, at = [], depth(scan)  # the operators over the scan, up to the join
        for line in reversed(before[:-1]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
        assert above and not any("Exchange" in x for x in above), p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_dead_batch_is_taken_in_again(spark, tmp_path):
    train, new = corpus_rows(3)
    t, n = spark.createDataFrame(train, TRAIN), spark.createDataFrame(new, NEW)
    root = f"file://{tmp_path}/c"
    corpus = merge.KeyedCorpus(spark, root, ["f1", "f2"], ["lang"], buckets=4)
    corpus.absorb(1, t, None)
    half = tmp_path / "c" / "corpus-0000000002-4"
    half.mkdir()
    (half / "part-0.parquet").write_text("half")
    assert [v for v, _ in corpus.versions()] == [1]
    corpus.absorb(2, None, n)
    for name in [r.name for r in spark.catalog.listTables() if r.name.startswith("sieveline_")]:
        spark.sql(f"DROP TABLE {name}")  # as in a new session
    more = merge.KeyedCorpus(spark, root, ["f1", "f2"], ["lang"], buckets=6)  # reads four buckets and writes six
    assert as_dict(more.view()) == plain_merge(train, new)
    more.absorb(3, None, n.where("_ord < 0"))
    assert more.versions()[-1][1].endswith("-6") and as_dict(more.view()) == plain_merge(train, new)


def test_merge_shuffles_by_longs(spark, tmp_path):
    train, new = corpus_rows(4)
    spark.createDataFrame(train, TRAIN).write.parquet(f"file://{tmp_path}/t")
    spark.createDataFrame(new, NEW).write.parquet(f"file://{tmp_path}/n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(merge.merge_schemas(spark.read.parquet(f"file://{tmp_path}/t"), spark.read.parquet(f"file://{tmp_path}/n"), ["f1", "f2"], ["lang"]))
        keys = re.findall(r"hashpartitioning\(([^)]*?), \d+\)|Sort \[([^\]]*)\]", p)
        assert keys and all(re.fullmatch(r"(\w+#\d+L( ASC NULLS FIRST)?(, )?)+", a or b) for a, b in keys), p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_of_empty_tables_and_ties(spark):
    t, n = spark.createDataFrame([], TRAIN), spark.createDataFrame([], NEW)
    assert merge.merge_schemas(t, n, ["f1", "f2"], ["lang"]).count() == 0
    t = spark.createDataFrame([("x", "a", "L1", "s1", 5), ("x", "a", "L2", "s2", 5), ("x", "b", "L3", None, None)], TRAIN)
    got = as_dict(merge.merge_schemas(t, n, ["f1", "f2"], ["lang"]))
    assert got["x", "b"] == ("L3", "", 0, 0, "train_only") and got["x", "a"][:2] in {("L1", "s1"), ("L2", "s2")}
    clash = spark.createDataFrame([("x", "a", "L1", "s1", 5, 1, 2)], TRAIN + ", h1 int, key int")
    assert as_dict(merge.merge_schemas(clash, n, ["f1", "f2"], ["lang"])) == {("x", "a"): ("L1", "s1", 0, 0, "train_only")}


def quoted(words):
    return ["\\Q" + w + "\\E" for w in words]


def test_keywords_equal_an_alternation(spark):
    r = random.Random(5)
    signs = "abAB éÉßſKk İiIıσςΣ.*\\#\n中\U0001f600ǅǆ"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 12))) for _ in range(300)] + ["", None, "x" * 300_000 + "Facção"]
    groups = {g: ["".join(r.choice(signs) for _ in range(r.randint(1, 3))) for _ in range(4)] for g in ("A", "B", "C")} | {"D": ["FACÇÃO", "facção"]}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, found string")  # a text column named as a helper
    rows = [(g, w) for g, ws in groups.items() for w in ws] * 2 + [(None, "a"), ("A", None)]
    kw = spark.createDataFrame(rows, "group string, keyword string")
    want = df.select("id", *[tx.matches_any("found", quoted(ws)).alias(g) for g, ws in groups.items()]).collect()
    want = {x["id"]: [g for g in groups if x[g]] for x in want}
    for block in (keywords.BLOCK, 16):
        got = keywords.with_hits(df, "found", kw, block=block)
        assert got.columns == ["id", "found", "hits"]
        assert {x["id"]: x["hits"] for x in got.collect()} == want
    assert len(keywords.blocks(kw, 16)) > 1


def test_keywords_of_odd_lists(spark):
    df = spark.createDataFrame([(1, "abc"), (None, None), (1, "abc")], "id int, t string")
    kw = lambda *rows: spark.createDataFrame(list(rows), "group string, keyword string")
    assert [r["hits"] for r in keywords.with_hits(df, "t", kw()).collect()] == [[]] * 3
    assert [r["hits"] for r in keywords.with_hits(df, "t", kw(("E", ""), ("G", "B"))).collect()] == [["E", "G"], ["E"], ["E", "G"]]
    assert keywords.with_hits(df.limit(0), "t", kw(("G", "b"))).count() == 0
    got = keywords.hit_rates(df, "id", "t", kw(("E", ""), ("G", "B"))).collect()
    assert {tuple(r) for r in got} == {(1, "E", 2, 2, 1.0), (None, "E", 1, 1, 1.0), (1, "G", 2, 2, 1.0)}


def test_keywords_cost_the_text_and_not_the_list():
    text = "lorem ipsum dolor sit amet " * 40_000
    times = []
    for n in (10, 1000, 10_000):
        auto, _ = keywords.automaton([("g", f"qx{i}z") for i in range(n)])
        start = time.process_time()
        assert not list(auto.iter(keywords.fold(text)))
        times.append(time.process_time() - start)
    assert times[2] < 5 * times[0] + 0.5


def test_keywords_do_not_shuffle(spark):
    df = spark.range(10).select("id", F.lit("a b").alias("t"))
    assert "Exchange" not in plan(keywords.with_hits(df, "t", spark.createDataFrame([("g", "a")], "group string, keyword string")))


def test_helper_columns_do_not_clash(spark):
    """Tables that have the helpers' own names as columns."""
    df = spark.createDataFrame([(1, "L1", "t", '[{"a": 1}, 2, {"a": 3}]', "x", "y")], "_ord int, final_category string, verdict string, raw_output string, arr string, Items string")
    got = parse.batch_items(df).collect()
    assert [(r["ordinal"], r["arr"], r["Items"]) for r in got] == [(0, "x", "y"), (2, "x", "y")]
    clean, actions = rules.apply_rules(df, F.struct(F.lit("relabel").alias("action"), F.lit("r").alias("reason"), F.lit("safe").alias("new_label")))
    row = clean.collect()[0]
    assert (row["final_category"], row["final_violation"], row["verdict"]) == ("safe", False, "t")
    assert [tuple(r) for r in actions.collect()] == [(1, "relabel", "r", "L1", "safe")]

"""The operators against brute force, exact round trips and held-out accuracy, with the edge cases each has to define."""

import base64
import collections
import gzip
import hashlib
import io
import itertools
import math
import random
import unicodedata
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sieveline.llm import _graph, bpe, chat, decontaminate, langid, lm, ngram_join, rlz, suffix_dedup, vector_dedup, warc
from sieveline.llm._spark import Work

DOC = "doc_id long, text string"


def corpus(seed=1):
    """Invented texts with cut-and-paste passages, edits, periods, copies, nulls, blanks and a long one."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randrange(2, 7))) for _ in range(400)]
    base = [" ".join(r.choice(vocab) for _ in range(r.choice([3, 60, 200, 500]))) for _ in range(25)]
    rows = list(enumerate(base))
    for j in range(40):
        a, b = r.choice(base), r.choice(base)
        i, k = r.randrange(len(a)), r.randrange(len(b))
        t = a[i : i + r.choice([90, 399, 400, 430, 1500])] + " " + b[k : k + r.choice([100, 405, 900])]
        if j % 3 == 0:
            p = r.randrange(len(t))
            t = t[:p] + "X" + t[p + 1 :]
        rows.append((1000 + j, t))
    rows += [(5000, "ab " * 400), (5001, "ab " * 90 + "x " + "ab " * 90), (5002, "a" * 900), (5003, None), (5004, ""), (5005, " \t a b\x0b"), (5006, "é" * 450)]
    rows += [(None, base[1]), (None, base[1]), (7, base[7]), (5007, " ".join(r.choice(vocab) for _ in range(30000)))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).repartition(5)


def windows(texts, n, of_words):
    seqs = [(x or "").encode().split() if of_words else (x or "").encode() for x in texts]
    at = lambda s, i: tuple(s[i : i + n]) if of_words else s[i : i + n]
    count = collections.Counter(at(s, i) for s in seqs for i in range(len(s) - n + 1))
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - n + 1):
            if count[at(s, i)] > 1:
                gone[i : i + n] = [True] * n
        yield s, gone


def test_op1_words(docs):
    want = sorted(str((i, len(s), sum(g), hashlib.sha256(b" ".join(w for w, x in zip(s, g, strict=True) if not x)).hexdigest())) for (i, _), (s, g) in zip(corpus(), windows([t for _, t in corpus()], 35, True), strict=True))
    assert sorted(str(tuple(r)) for r in rlz.report(docs).collect()) == want


def test_op1_remove_keeps_rows_and_columns(docs):
    d = docs.withColumns({"k1": F.lit("x"), "spans": F.lit(1), "n_chars": F.lit(-1).cast("long")})
    out = rlz.remove(d)
    assert out.columns == d.columns and out.count() == d.count()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[5003] is None and kept[5005] == " \t a b\x0b" and kept[7] == ""


def test_op1_factors_are_copies_and_cover_what_goes(docs):
    texts = collections.defaultdict(list)
    for i, t in corpus():
        texts[i].append((t or "").split())
    gone = collections.defaultdict(set)
    for f in rlz.factors(docs).collect():
        assert f["length"] >= 35
        own = [t[f["start"] : f["start"] + f["length"]] for t in texts[f["doc_id"]] if len(t) >= f["start"] + f["length"]]
        there = [t[f["source_start"] : f["source_start"] + f["length"]] for t in texts[f["source_id"]]]
        assert any(a == b and len(a) == f["length"] for a in own for b in there)
        assert (f["doc_id"], f["start"]) != (f["source_id"], f["source_start"]) or len(texts[f["doc_id"]]) > 1
        gone[f["doc_id"]] |= {*range(f["start"], f["start"] + f["length"])}
    for (i, _), (_, g) in zip(corpus(), windows([t for _, t in corpus()], 35, True), strict=True):
        if i not in (None, 7):  # these ids stand for several rows
            assert gone[i] == {k for k, x in enumerate(g) if x}


def test_op1_parse_is_greedy(spark):
    """Of two sources the one that goes farther is taken; a new factor starts where it ends."""
    at, n = [0, 5, 9, 30], [5, 4, 1, 2]
    a, b, own = (1, 0, 100), (2, 0, 200), (9, 9, 5)
    places = [(a, b), ((1, 0, 105), (2, 0, 205)), ((2, 0, 209), (3, 0, 0)), (own, (1, 0, 900))]
    assert rlz.parse(at, n, places, (9, 9), 35) == [(0, 44, b), (30, 36, (1, 0, 900))]
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words[:120])), (2, " ".join(["x", *words]))]
    got = {tuple(r) for r in rlz.factors(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {(1, 0, 120, 2, 1), (2, 1, 120, 1, 0)}


def test_op1_op3_repeated_rows_share_short_lists(spark):
    """3,000 equal rows with no id: each stretch once, in one key."""
    text = " ".join(f"word{i}" for i in range(300))
    d = spark.createDataFrame([(None, text)] * 3000, DOC).repartition(7)
    for found in (rlz.pieces(d), suffix_dedup.spans(d)):
        rows = found.collect()
        assert len(rows) == 1 and len(rows[0]["spans"]) < 40
    assert {tuple(r) for r in rlz.report(d).select("n_words", "n_removed").distinct().collect()} == {(300, 300)}


def test_op1_remove_with_clashing_names(docs):
    d = docs.withColumns({"K1": F.lit("x"), "k2": F.lit(2), "new_text": F.lit("y"), "cover": F.lit(3)})
    out = rlz.remove(d)
    assert out.columns == d.columns and {tuple(r) for r in out.select("K1", "k2", "new_text", "cover").distinct().collect()} == {("x", 2, "y", 3)}


def test_op3_small_windows(spark):
    rows = [(1, "abcabcx"), (2, "zzabcay"), (3, "aaaa"), (4, "é1é1"), (5, None)]
    for n in (1, 3, 4):
        want = sorted(str((i, len(s), sum(g))) for (i, _), (s, g) in zip(rows, windows([t for _, t in rows], n, False), strict=True))
        got = suffix_dedup.report(spark.createDataFrame(rows, DOC), n).select("doc_id", "n_bytes", "n_removed")
        assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_op3_bytes(docs):
    want = sorted(str((i, len(s), sum(g), sum(g[k] and not (k and g[k - 1]) for k in range(len(g))), hashlib.sha256(bytes(b for b, x in zip(s, g, strict=True) if not x)).hexdigest())) for (i, _), (s, g) in zip(corpus(), windows([t for _, t in corpus()], 400, False), strict=True))
    assert sorted(str(tuple(r)) for r in suffix_dedup.report(docs).collect()) == want


def linked(sets, same):
    n = len(sets)
    near = [[j for j in range(n) if j != i and same(sets[i], sets[j])] for i in range(n)]
    part = list(range(n))
    for i in range(n):
        todo, reach = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        part[i] = reach
    return near, part


def near_rows(seed=3):
    r = random.Random(seed)
    rows = [(i, t) for i, t in corpus() if i is not None and i < 40]
    for j in range(60):
        words = r.choice(rows[:25])[1].split()
        for _ in range(r.choice([0, 1, 1, 2])):
            words[r.randrange(len(words))] = r.choice(["new", "other"])
        rows.append((100 + j, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, "one two"), (903, "one two"), (None, "one  two"), (904, "ONE two")]


def shingle(t):
    w = (t or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_op4_links(spark):
    rows = near_rows()
    sets = [shingle(t) for _, t in rows]
    near, part = linked(sets, lambda a, b: bool(a and b) and 10 * len(a & b) >= 8 * len(a | b))
    least = lambda xs: min((x for x in xs if x is not None), default=None)
    want = sorted(str((i, least(rows[j][0] for j in part[k]), len(near[k]))) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, DOC).withColumn("node", F.lit(1)).repartition(6)
    assert sorted(str(tuple(r)) for r in ngram_join.report(df).collect()) == want
    kept = [r["doc_id"] for r in ngram_join.one_each(df).collect()]
    classes = {min(x for x in (rows[j][0] for j in p) if x is not None) for k, p in enumerate(part) if sets[k]}
    assert sorted(kept) == sorted(classes | {900, 901})


def test_op4_recall_at_the_threshold(spark):
    """Pairs at a Jaccard similarity of just 0.8 and more."""
    r = random.Random(9)
    rows, found = [], 0
    for k in range(300):
        words = [f"p{k}w{i}" for i in range(104)]  # 100 shingles
        other = words.copy()
        for _ in range(2):  # 5 or 10 of them gone: 90 shared of 110, or 95 of 105
            other[r.choice(range(10, 94))] = "changed"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    sets = {i: shingle(t) for i, t in rows}
    near = [k for k in range(300) if 10 * len(sets[2 * k] & sets[2 * k + 1]) >= 8 * len(sets[2 * k] | sets[2 * k + 1])]
    got = {x["doc_id"]: x["n_links"] for x in ngram_join.report(spark.createDataFrame(rows, DOC)).collect()}
    found = sum(got[2 * k] == 1 for k in near)
    assert len(near) > 250 and found / len(near) >= 0.98
    assert all(got[i] == 0 for i in got if i // 2 not in near)


def test_op4_long_sets_are_cut_by_size(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SET_SIZE", 16)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(12)] + [(50 + i, " ".join(base[:20] + [f"y{i}"] * 3)) for i in range(9)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.report(spark.createDataFrame(rows, DOC)).collect()}
    assert {got[i] for i in range(12)} == {(0, 11)}


def test_op4_one_of_equal_rows_is_always_the_same(spark):
    df = spark.createDataFrame([(1, "a b c", i) for i in range(20)] + [(2, None, 7)], "doc_id long, text string, k1 int")
    kept = {tuple(sorted(tuple(map(str, r)) for r in ngram_join.one_each(df.repartition(n, "k1")).collect())) for n in (1, 3, 7)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_op4_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "SPLIT", 4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:198], f"x{i}", f"y{i}"])) for i in range(120)]
    got = ngram_join.report(spark.createDataFrame(rows, DOC)).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 119)}


@pytest.mark.parametrize("shared, tries", [(40, 2), (90, 3)])
def test_op4_large_buckets_are_split_on(spark, monkeypatch, shared, tries):
    """Sets that share much but are no pairs, among them near copies, with every link told once. Where they share 40 of 120
    shingles, large buckets are split on; where they share 90, that would leave more pairs, and they are searched as they are."""
    monkeypatch.setattr(ngram_join, "TRIES", tries)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "SPLIT", 4)
    monkeypatch.setattr(ngram_join, "LARGE", 8)
    seen = []
    deeper = ngram_join._deeper
    monkeypatch.setattr(ngram_join, "_deeper", lambda *a: seen.append(deeper(*a)) or seen[-1])
    r = random.Random(shared)
    base = [f"w{i}" for i in range(shared + 4)]
    rows = []
    for k in range(180):
        words = base + [f"k{k}w{i}" for i in range(120 - shared)]
        rows.append((10 * k, " ".join(words)))
        for c in range(k % 3):
            other = words.copy()
            other[r.randrange(len(base) + 6, len(words) - 6)] = f"changed{c}"
            rows.append((10 * k + 1 + c, " ".join(other)))
    sets = [shingle(t) for _, t in rows]
    near, part = linked(sets, lambda a, b: 10 * len(a & b) >= 8 * len(a | b))
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in ngram_join.report(spark.createDataFrame(rows, DOC).repartition(5)).collect()}
    want = {i: (min(rows[j][0] for j in part[k]), len(near[k])) for k, (i, _) in enumerate(rows)}
    assert got == want and max(n for _, n in want.values()) == 2
    (ends, paths), runs = seen[0], ngram_join.n_runs(0.8, ngram_join.RECALL)
    counts = [e.agg(F.count_if(F.col("r") < runs), F.count_if(F.col("r") >= runs)).first() for e in ends]
    assert ends and paths > runs and (sum(c[1] for c in counts) > 0) == (shared == 40) and sum(c[0] for c in counts)
    assert all(e.groupBy("node", "r").count().where("count > 1").isEmpty() for e in ends)


def test_op4_hot_buckets_take_no_shuffle(spark):
    rows = spark.createDataFrame([(i, 1 if i < 90 else i) for i in range(100)], "node long, leaf long")
    facts = rows.groupBy("leaf").agg(F.count("*").alias("m")).where("m > 0")
    for most in (0, 10, 90, 1000):
        met = ngram_join._met(rows, facts, most)
        assert sorted(map(tuple, met.select("node", "leaf", "m").collect())) == [(i, 1 if i < 90 else i, 90 if i < 90 else 1) for i in range(100)]


def test_components_of_long_paths(spark):
    """Paths of 4,000 and 3 nodes with shuffled ids, a star and a loop: one label each, in few rounds."""
    r = random.Random(8)
    ids = [r.randrange(-(2**63), 2**63) for _ in range(4103)]
    path, short, star = ids[:4000], ids[4000:4003], ids[4003:]
    pairs = [*itertools.pairwise(path), *itertools.pairwise(short), *((star[0], x) for x in star[1:]), (path[5], path[5])]
    r.shuffle(pairs)
    work = Work(spark, "paths")
    got = {x["node"]: x["comp"] for x in _graph.components(spark.createDataFrame(pairs, "a long, b long"), work).collect()}
    assert got == {x: min(p) for p in (path, short, star) for x in p}
    assert work.n < 30


def vector_rows(seed=0):
    g = np.random.default_rng(seed)
    base = g.standard_normal((60, 16))
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in np.float32(base[i % 20] + g.standard_normal(16) * 0.1)]) for i in range(60)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]
    return rows + [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, []), (304, [1.0, None]), (305, [2.0, 0.0]), (306, [1.0, -0.0])]


def test_op9_links(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 8)
    rows = vector_rows()
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if fine(v) else None for _, v in rows]
    near, part = linked(unit, lambda a, b: a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9)
    want = sorted((i, len(near[k]), min(rows[j][0] for j in part[k])) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("t", F.lit(0)).repartition(4)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in vector_dedup.report(df, recall=0.9999).collect())
    assert got == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in vector_dedup.report(df).collect())


def test_op9_recall_of_the_query(spark):
    """Links found by the query's own parameters, against brute force; none that isn't there."""
    g = np.random.default_rng(6)
    centre = g.standard_normal((250, 24))
    rows = [(i * 8 + j, (c + 0.3 * g.standard_normal(24)).astype(np.float32).tolist()) for i, c in enumerate(centre) for j in range(8)]
    unit = np.array([v for _, v in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in vector_dedup.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    links = np.array([got[i] for i, _ in rows])
    assert (links <= want).all() and links.sum() / want.sum() >= 0.98 and want.sum() > 2000


def test_op9_recall_at_the_threshold():
    g = np.random.default_rng(5)
    a = g.standard_normal((800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = g.standard_normal((800, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    k, tables = vector_dedup.parameters(50_000)
    met = (vector_dedup.keys(a, k, tables) == vector_dedup.keys(b, k, tables)).any(1)
    assert met.mean() >= 0.95


@pytest.mark.parametrize("group", [512, 4])
def test_op5_against_counts(spark, monkeypatch, group):
    monkeypatch.setattr(lm, "GROUP", group)
    monkeypatch.setattr(lm, "CHUNK", 30_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 40_000)
    learned = {}
    em = lm.expectation_maximisation
    monkeypatch.setattr(lm, "expectation_maximisation", lambda c, n, v: learned.setdefault("w", em(c, n, v)))
    rows = [*corpus(), *((6000 + i, t) for i, t in enumerate(["The THE the", "Ébc Ébc", None]))]
    got = sorted((tuple(r) for r in lm.report(spark.createDataFrame(rows, DOC).repartition(4)).collect()), key=str)
    low = lambda b: bytes(x + 32 if 65 <= x <= 90 else x for x in b)
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    seqs = [(i, [*low((t or "").encode()).split(), None]) for i, t in rows]
    c, pairs, starts = collections.Counter(), collections.Counter(), 0
    for i, s in seqs:
        if fold(i) != 0:
            c.update(s)
            pairs.update(zip(["<s>", *s[:-1]], s, strict=True))
            starts += 1
    n, v = sum(c.values()), len(c)
    want = []
    for i, s in seqs:
        score = 0.0
        for u, t in zip(["<s>", *s[:-1]], s, strict=True):
            cu = starts if u == "<s>" else c[u]
            w = learned["w"][min(math.frexp(cu)[1], lm.CONTEXTS - 1)]
            score += math.log10(w[0] * pairs[u, t] / max(cu, 1) + w[1] * c[t] / n + w[2] / (v + 1))
        want.append((i, fold(i) == 0, len(s), sum(c[t] > 0 for t in s), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in s), score))
    want.sort(key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in got], [x[5:] for x in want])
    assert np.allclose(learned["w"].sum(1), 1)


def test_op5_em_finds_the_mixture():
    g = np.random.default_rng(0)
    cells = []
    # an outcome with p2 = 1, p1 = 1/2 in 7 of 10 cases, else p2 = 0, p1 = 1/2: likeliest at l2 = 0.4, l1 = 0.6
    for _ in range(4000):
        cells.append((5, 0, 8, 1) if g.random() < 0.7 else (5, 1, 8, 1))
    w = lm.expectation_maximisation(np.array(cells), 4, 3)
    assert abs(w[5][0] - 0.4) < 0.03 and w[5][2] < 0.01 and abs(w[5].sum() - 1) < 1e-9


def test_op6_packages_are_zip_and_read_back(spark):
    for wide in (False, True):
        out = io.BytesIO()
        p = warc.Packer(out, wide)
        for i in range(4):
            p.add(warc.record(i, "http://x/é\r\ny", b"hi" * i, warc.digest(b"hi" * i), None if i else 3))
        p.close()
        data = out.getvalue()
        z = zipfile.ZipFile(io.BytesIO(data))
        assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX] and all(i.compress_type == 0 for i in z.infolist())
        assert gzip.decompress(z.read(warc.DATA)).count(b"WARC/1.1\r\n") == 4
        got = list(warc.Package(lambda at, n, data=data: data[at : at + n], len(data)).records())
        assert [len(x[2]) for x in got] == [0, 2, 4, 6] and got[0][0]["warc-type"] == "revisit"
        asked = []
        package = warc.Package(lambda at, n, data=data, asked=asked: asked.append((at, n)) or data[at : at + n], len(data))
        before = len(asked)
        assert len([*package.records()]) == 4 and len(asked) - before == 2  # the index and one stretch of records
    assert [warc.arrow_uri(x) for x in ("file:/a", "/a", "file:///a", "s3a://b/c", "wasbs://k@acc.blob.core.windows.net/p", "gs://b/c", "hdfs://h:1/p")] == [
        "file:///a", "file:///a", "file:///a", "s3://b/c", "abfss://k@acc.dfs.core.windows.net/p", "gs://b/c", "hdfs://h:1/p"]
    with pytest.raises(ValueError, match="ZIP"):
        warc.Package(lambda at, n: b"x" * n, 100)
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "http://c", None), (4, "u", ""), (5, "u", "né\r\n\r\n"), (5, "u", "né\r\n\r\n"), (None, "u", "same"), (None, "v", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit("clash"))
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = i == last[h or ""] or last[h or ""] == -1
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else last[h or ""]))
    assert sorted(map(str, map(tuple, warc.report(df).collect()))) == sorted(map(str, want))
    assert {r[3] for r in warc.report(df, min_bytes=100).collect()} == {"response"}


@pytest.fixture(scope="module")
def tik():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}  # noqa: SIM115
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op7_as_tiktoken(spark, tik):
    path, enc = tik
    r = random.Random(2)
    rows = [*corpus(), (8000, "<|endoftext|> it's  \x1c\x85 漢字🙂 12345"), (8001, "a" * 5000)]
    rows += [(9000 + i, "".join(r.choice("ab  \n\t\r\x1c\x85é漢'sTre1-; 🙂") for _ in range(40))) for i in range(200)]
    out = bpe.encode(spark.createDataFrame(rows, DOC), path, public_tokenizers.PATTERN)
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    back = {x["doc_id"]: bytes(x["body"]) for x in bpe.decode(out.where("doc_id >= 8000"), path).collect()}
    assert back == {i: t.encode() for i, t in rows if i is not None and i >= 8000}


def test_op7_every_block_of_code_points(tik):
    path, enc = tik
    mine = bpe.Encoder(path, public_tokenizers.PATTERN)
    for block in itertools.chain(range(0, 0x3000, 64), range(0x3000, 0x110000, 64 * 61)):
        t = "".join(f"a{chr(c)} {chr(c)}{chr(c)}1" for c in range(block, block + 64) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(mine(t), "<u4").tolist() == enc.encode_ordinary(t)


def test_op7_perfect_hash_is_minimal():
    g = np.random.default_rng(1)
    hi, lo = g.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    assert sorted(bpe.PerfectHash(hi, lo)(hi, lo).tolist()) == list(range(5000))


def test_op8_spans(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 20, 14, 6, 3])] + [(50, None), (51, "")]
    noise = lambda n: " ".join(word() for _ in range(n))
    w = items[0][1].split()
    swapped = " ".join("zzzz" if i % 7 == 3 else x for i, x in enumerate(w))
    spoiled = " ".join("zzzz" if i % 3 == 1 else x for i, x in enumerate(w))
    rows = [(1, f"{noise(40)} {items[0][1]} {noise(9)}"), (2, f"{noise(5)} {items[0][1].upper()}!"), (3, f"{noise(9)} {swapped} {noise(3)}"), (4, f"{noise(9)} {spoiled}"), (5, noise(300)), (6, None), (7, "")]
    rows += [(8, f"{items[1][1]} x {items[2][1]}"), (9, f"{noise(3)} {items[3][1]}"), (10, items[4][1]), (None, items[2][1]), (11, " ".join(w[:10])), (12, " ".join(w[:13]))]
    df, it = spark.createDataFrame(rows, DOC).withColumn("item_id", F.lit(0)), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 0), (2, 0), (3, 0), (8, 1), (8, 2), (9, 3), (10, 4), (None, 2), (12, 0)}
    got = decontaminate.matches(df, it).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == want
    assert next((x["doc_start"], x["n_words"], x["n_same"]) for x in got if x["doc_id"] == 1) == (40, 30, 30)
    other = decontaminate.matches(df, it, broadcast_chars=0).collect()
    assert sorted(map(str, map(tuple, other))) == sorted(map(str, map(tuple, got)))
    for limit in (decontaminate.BROADCAST_CHARS, 0):
        assert {(x["doc_id"], x["item_id"]) for x in decontaminate.matches(df, it, broadcast_chars=limit, least=5).collect()} == want - {(10, 4)}
    clean = decontaminate.clean(df, it)
    assert clean.columns == df.columns and sorted(x["doc_id"] for x in clean.collect()) == [4, 5, 6, 7, 11]


def test_op8_short_items_punctuation_and_unspaced_scripts(spark):
    items, rows = [], []
    for n in range(5, 12):  # every substitution that similarity 0.8 admits, and one too many
        w = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(w)))
        for k in (n // 5, n // 5 + 1):
            rows += [(k * 100 + n, "before " + " ".join("other" if i in gone else x for i, x in enumerate(w)) + " after") for gone in itertools.combinations(range(n), k)]
    items += [(20, "机器学习模型的训练数据不应包含测试题目"), (21, "この問題は学習データに含まれてはならない"), (22, "ข้อมูลทดสอบต้องไม่อยู่ในชุดฝึก"), (23, "one two three four five six"), (24, "你好世界"), (25, "two words"), (26, "alone")]
    rows += [(1020, "他说：“机器学习模型的训练数据不应包含考试题目。”然后"), (1021, "「この問題は学習データに含まれてはならない」と。"), (1022, "ก" + items[-5][1] + "ข abc"), (1023, "«one two—three “four” five…six»"), (1024, "说你好世界。"), (2024, "你好地界"), (1025, "only two Words!"), (2025, "two other words"), (1026, "not ALONE?"), (2026, "lone")]
    df, it = spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string")
    want = collections.Counter((d, d % 100) for d, _ in rows if d >= 1000 and d < 2000 or d < 1000 and d // 100 == d % 100 // 5)
    for limit in (decontaminate.BROADCAST_CHARS, 0):
        assert collections.Counter((x["doc_id"], x["item_id"]) for x in decontaminate.matches(df, it, broadcast_chars=limit).collect()) == want


def test_op8_repeated_rows_in_both_ways(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(15)) for c in "ab")
    df = spark.createDataFrame([(1, t), (1, t), (1, t), (2, f"x {t} {u}"), (None, u), (None, u)], DOC)
    it = spark.createDataFrame([(7, t), (7, t), (8, t), (None, u), (None, u)], "item_id long, text string")
    want = collections.Counter({(1, 7): 6, (1, 8): 3, (2, 7): 2, (2, 8): 1, (2, None): 2, (None, None): 4})
    for limit in (decontaminate.BROADCAST_CHARS, 0):
        assert collections.Counter((x["doc_id"], x["item_id"]) for x in decontaminate.matches(df, it, broadcast_chars=limit).collect()) == want


def test_op8_recall_by_item_length():
    """Items of 5 to 30 words with random substitutions that similarity 0.8 admits, against brute force over all pairs."""
    r = random.Random(11)
    for n in range(5, 31):
        items = [" ".join(f"i{n}k{k}w{j}" for j in range(n)) for k in range(3)]
        at = decontaminate.Items([0, 1, 2], items)
        met = tried = 0
        for _ in range(150):
            k, gone = r.randrange(3), set(r.sample(range(n), n // 5))
            text = "a b " + " ".join("other" if j in gone else w for j, w in enumerate(items[k].split())) + " c"
            values, first = decontaminate.tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
            brute = [i for i in range(3) if any(decontaminate.overlap(values, at.values[at.first[i] : at.first[i + 1]], d, 0.8, 12) for d in range(-n, len(values)))]
            assert brute == [k]
            tried += 1
            met += any(i == k and decontaminate.overlap(values, at.values[at.first[k] : at.first[k + 1]], d, 0.8, 12) is not None for _, i, d in zip(*(x.tolist() for x in at.hits(values, first)), strict=True))
        assert met / tried >= (1 if n < 12 else 0.97), n


def test_op8_texts_that_repeat_themselves(spark, monkeypatch):
    """Very many diagonals in both ways; very long texts; the columns of helpers in the input."""
    monkeypatch.setattr(decontaminate, "DIAGONALS", 16)
    period = " ".join(["tick tock boom"] * 4000)
    item = " ".join(["tick tock boom"] * 6)
    df = spark.createDataFrame([(1, period), (2, "word " * 50_000 + item), (3, "word " * 100)], DOC).withColumns({c: F.lit("x") for c in ("row_key", "k1", "i1", "diagonals")})
    it = spark.createDataFrame([(7, item), (8, "no such words are in any of these texts at all ok")], "item_id long, text string")
    a, b = ([tuple(x) for x in decontaminate.matches(df, it, broadcast_chars=n).collect()] for n in (decontaminate.BROADCAST_CHARS, 0))
    assert sorted(a) == sorted(b) == [(1, 7, 0, 0, 18, 18), (2, 7, 49_997, 0, 18, 15)]
    out = decontaminate.clean(df, it)
    assert out.columns == df.columns and [tuple(r)[2:] for r in out.collect()] == [("x",) * 4]


def test_op8_against_brute_force_over_given_documents(spark):
    """Every document against every item over sf0.001: the longest stretch of any diagonal that shares four words or more."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    it = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()
    values = lambda t: decontaminate.tokens(np.frombuffer((t or "").lower().encode(), np.uint8), np.array([0, len((t or "").lower().encode())]))[0]
    items = {r["item_id"]: values(r["text"]) for r in it}
    where = collections.defaultdict(list)
    for i, v in items.items():
        for p, x in enumerate(v.tolist()):
            where[x].append((i, p))
    want = {}
    for r in d:
        v = values(r["text"])
        shared = collections.Counter((i, at - p) for at, x in enumerate(v.tolist()) for i, p in where.get(x, ()))
        for (i, diagonal), n in shared.items():
            if n >= 4 and (x := decontaminate.overlap(v, items[i], diagonal, 0.8, 12)):
                want[r["doc_id"], i] = max(x[2], want.get((r["doc_id"], i), 0))
    for limit in (decontaminate.BROADCAST_CHARS, 0):
        got = decontaminate.matches(*(spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark")), broadcast_chars=limit).collect()
        assert {(r["doc_id"], r["item_id"]): r["n_words"] for r in got} == want and len(want) > 2


def twins(n):
    """Two words of 2**n letters, each the other's complement: for every q they have one polynomial hash modulo 2**64."""
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [10, 12])
def test_words_that_collide_modulo_a_power_of_two(spark, n):
    a, b = twins(n)
    rest = [f"w{i}" for i in range(34)]
    df = spark.createDataFrame([(1, " ".join([a, *rest])), (2, " ".join([b, *rest])), (3, "other words")], DOC)
    assert {tuple(r) for r in rlz.report(df).select("doc_id", "n_removed").collect()} == {(1, 0), (2, 0), (3, 0)}
    short = spark.createDataFrame([(1, f"{a} x y z w"), (2, f"{b} x y z w")], DOC)
    assert {tuple(r) for r in ngram_join.report(short).select("doc_id", "n_links").collect()} == {(1, 0), (2, 0)}
    assert ngram_join.one_each(short).count() == 2
    assert {tuple(r) for r in suffix_dedup.report(spark.createDataFrame([(1, a), (2, b)], DOC), len(a)).select("doc_id", "n_removed").collect()} == {(1, 0), (2, 0)}
    held, trained = ([i for i in range(200) if (zlib.crc32(str(i).encode()) % 10 == 0) == kind] for kind in (True, False))
    known = {r["doc_id"]: r["n_known"] for r in lm.report(spark.createDataFrame([(held[0], b), (held[1], a), (trained[0], a), (trained[1], a)], DOC)).collect()}
    assert (known[held[0]], known[held[1]]) == (1, 2)  # the end, and the word where it is known
    it = spark.createDataFrame([(7, f"{a} one two three four")], "item_id long, text string")
    for limit in (decontaminate.BROADCAST_CHARS, 0):
        got = decontaminate.matches(spark.createDataFrame([(1, f"{b} one two three four"), (2, f"{a} one two three four")], DOC), it, broadcast_chars=limit).collect()
        assert {(r["doc_id"], r["n_same"]) for r in got} == {(1, 4), (2, 5)}


def test_op1_op3_unit_sequences_that_collide_modulo_a_power_of_two(spark):
    """The same letters as words, in windows that long."""
    a, b = (" ".join(x) for x in twins(10))
    df = spark.createDataFrame([(1, a), (2, b)], DOC)
    assert {tuple(r) for r in rlz.report(df, 1024).select("doc_id", "n_removed").collect()} == {(1, 0), (2, 0)}


def test_op1_op3_very_long_texts(spark):
    """Texts beyond what is worked on at once: over 524,288 words and bytes, with passages across the cuts."""
    r = random.Random(5)
    words = [f"{r.randrange(10**6):x}" for _ in range(600_000)]
    long, copy = " ".join(words), " ".join(words[524_200:524_400])
    rows = [(1, long), (2, f"x {copy} y"), (3, None)]
    df = spark.createDataFrame(rows, DOC)
    got = {x["doc_id"]: (x["n_words"], x["n_removed"]) for x in rlz.report(df).collect()}
    assert got == {1: (600_000, 200), 2: (202, 200), 3: (0, 0)}
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"]) for x in suffix_dedup.report(df).collect()}
    n = len(copy) + 2  # the blanks at both ends belong to it
    assert got == {1: (len(long), n, 1), 2: (len(copy) + 4, n, 1), 3: (0, 0, 0)}


def test_few_partitions_change_nothing(spark, docs, monkeypatch):
    """Above the ceiling a task takes several groups."""
    rows = lambda f: sorted("|".join(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in f(docs).collect())
    want = [rows(f) for f in (lm.report, ngram_join.report)]
    monkeypatch.setattr("sieveline.llm._spark.MOST_PARTS", 1)
    monkeypatch.setattr("sieveline.llm.lm.GROUP", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert [rows(f) for f in (lm.report, ngram_join.report)] == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_op8_overlap_is_the_longest():
    r = random.Random(0)
    for _ in range(300):
        same = [r.random() < 0.75 for _ in range(r.randrange(1, 25))]
        best = max((j - i for i in range(len(same)) for j in range(i + 1, len(same) + 1) if sum(same[i:j]) >= 0.8 * (j - i) - 1e-9), default=0)
        found = decontaminate.overlap(np.array([1 if s else 2 for s in same]), np.ones(len(same), int), 0, 0.8, 1)
        assert (found[2] if found else 0) == best


def test_op10_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "12 34 !", "fr"), (-4, "é", None)], "doc_id long, text string, lang string")
    d = docs.select("doc_id", "text", "lang").unionByName(extra).withColumn("held_out", F.lit("clash"))
    out = {r["doc_id"]: r for r in langid.report(d).collect()}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (-1, -2, -3)) and out[-4]["lang_pred"] != "und"
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in truth if out[i]["held_out"]} == set(held)
    assert sum(out[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.98
    kept = langid.identified(d.withColumn("lang_pred", F.lit("clash")).drop("held_out"))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred"] and kept.where("doc_id < 0").count() == 1 and kept.where("lang IS NULL").count() == 0


def grams(text):
    """The plain form: characters, lower-cased, all but letters and marks as blanks."""
    c = [(x.lower() if len(x.lower()) == 1 else x) if unicodedata.category(x)[0] in "LM" else " " for x in text]
    return {tuple(c[i : i + n]) for n in (1, 2, 3) for i in range(len(c) - n + 1)}


def test_op10_is_the_plain_kernel(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1, "Съешь же ещё этих мягких булок", "ru"), (-2, "漢字とかな、また 漢字", "ja"), (-3, "İstanbul'da ŞİŞLİ", "tr")], "doc_id long, text string, lang string")
    docs = docs.unionByName(extra).where("text IS NOT NULL")
    rows = langid._sample(docs)
    model = langid.fit(docs)
    assert model.langs == sorted({x for x, _ in rows}) and {"ru", "ja", "tr"} <= set(model.langs)
    code = lambda g: sum(ord(x) << 20 * k for k, x in enumerate(reversed(g))) | {1: 1 << 61, 2: 1 << 62, 3: 0}[len(g)]
    vocab = set(model.vocab.tolist())
    sets = [{code(g) for g in grams(t)} & vocab for _, t in rows]
    df = collections.Counter(c for _, t in rows for c in {code(g) for g in grams(t)})
    assert vocab <= set(df) and (len(vocab) == len(df) or len(vocab) >= 6144)
    lang, turn, seen = np.array([model.langs.index(x) for x, _ in rows]), [], collections.Counter()
    for x in lang:
        turn.append(seen[x])
        seen[x] += 1
    chosen = sorted(range(len(rows)), key=lambda i: (turn[i], lang[i]))[: max(128, 2 * len(model.langs))]
    kernel = lambda a, b: len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))
    k_xm = np.array([[kernel(a, sets[m]) for m in chosen] for a in sets])
    k_mm = k_xm[chosen]
    # the same ridge problem, solved by least squares over stacked rows
    value, vector = np.linalg.eigh(k_mm)
    keep = value > 1e-6 * value.max()
    z = k_xm @ vector[:, keep] / np.sqrt(value[keep])
    w = np.array([1 / (lang == x).sum() for x in lang])
    w /= w.mean()
    y = np.where(lang[:, None] == np.arange(len(model.langs)), 1.0, -1.0)
    zm, ym = np.average(z, 0, w), np.average(y, 0, w)
    left = np.vstack([(z - zm) * np.sqrt(w)[:, None], np.sqrt(langid.RIDGE * len(z)) * np.eye(z.shape[1])])
    right = np.vstack([(y - ym) * np.sqrt(w)[:, None], np.zeros((z.shape[1], y.shape[1]))])
    want = (z - zm) @ np.linalg.lstsq(left, right, rcond=None)[0] + ym
    assert np.abs(k_xm @ model.weights + model.bias - want).max() < 2e-3
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model, "doc_id").collect()}
    for r in docs.collect():
        g = {code(x) for x in grams(r["text"])} & vocab
        out = np.array([kernel(g, sets[m]) for m in chosen]) @ model.weights + model.bias
        top = np.sort(out)[::-1]
        if any(unicodedata.category(c)[0] == "L" for c in r["text"]) and top[0] - top[1] > 1e-3:
            assert got[r["doc_id"]][0] == model.langs[int(out.argmax())]
            assert abs(got[r["doc_id"]][1] - min(1, 0.5 + (top[0] - top[1]) / 4)) < 1e-3


def test_op10_lookups_agree():
    text = "The quick brown fox, élan Ünïcode ŞİŞLİ 漢字 мир " * 3
    chars, _ = langid.points(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert chars.tolist() == [ord(c) for c in text]
    codes = np.unique(np.concatenate(langid._codes(chars[:100])))[::2]
    narrow, wide = langid.Lookup(codes), langid.Lookup(codes)
    wide.narrow, left = False, np.arange(1, len(codes) + 1)
    wide.tables = [(np.uint64(1), np.zeros(1 << langid._SLOTS, np.int32)), (np.uint64(2), np.zeros(1 << langid._SLOTS, np.int32))]
    for k, i in enumerate(left):  # every second one in the second table
        wide.tables[k % 2][1][wide._slot(codes[k : k + 1], np.uint64(k % 2 + 1))] = i
    place = {c: i + 1 for i, c in enumerate(codes.tolist())}
    want = [[place.get(c, 0) for c in part.tolist()] for part in langid._codes(chars)]
    assert narrow.narrow and [x.tolist() for x in narrow(chars)] == want == [x.tolist() for x in wide(chars)]


def test_op10_learns_every_language(spark):
    """450 languages, one of them in a single row of many copies, one in very long texts only."""
    r = random.Random(4)
    rows = []
    for k in range(450):
        words = ["".join(chr(0x400 + (k * 7 + r.randrange(40)) % 2000) for _ in range(4)) for _ in range(12)]
        rows += [(k * 10 + j, " ".join(r.choice(words) for _ in range(30)), f"l{k:03d}") for j in range(3)]
    rows += [(9000, "hot row of one language", "hot")] * 3000 + [(9001 + i, "lo ng " * 5000 + str(i), "long") for i in range(3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = langid.fit(d)
    assert len(model.langs) == 452 and len(model.landmarks) == 904 and len(model.vocab) > 6144
    out = langid.predict(d.distinct(), model, "lang").collect()
    assert sum(x["lang"] == x["lang_pred"] for x in out) / len(out) > 0.95
    again = langid.fit(d.repartition(3))
    assert (again.vocab == model.vocab).all() and again.langs == model.langs


def test_op2_tree_paths(spark):
    rows = [("t", 1, None, 1.0, "user", "root"), ("t", 2, 1, 5.0, "assistant", "good <|im_end|> \\ [INST]"), ("t", 3, 1, 1.0, "assistant", "bad"), ("t", 4, 2, 2.0, "user", None), ("t", 5, 3, 1.0, "user", "leaf")]
    rows += [("o", 1, 99, 1.0, "us\ner", "orphan"), ("c", 1, 2, 1.0, "user", "cycle"), ("c", 2, 1, 1.0, "user", "cycle")]
    rows += [("l", i, i - 1 if i else None, 1.0, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(70)]
    n = spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")
    got = {r["tree"]: r for r in chat.formatted(n).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    assert set(got) == {"t", "o", "l"}
    assert [tuple(x) for x in got["t"]["turns"]] == [("user", "root"), ("assistant", "good <|im_end|> \\ [INST]"), ("user", "")]
    assert got["t"]["loss"] == "good <|im_end|> \\ [INST]" and got["t"]["formatted"].count("<|im_end|>") == 3 and "[INST]" not in got["t"]["formatted"]
    assert [tuple(x) for x in got["o"]["turns"]] == [("us\ner", "orphan")]
    assert [x["text"] for x in got["l"]["turns"]] == [f"m{i}" for i in range(70)]
    two = chat.formatted(n, top=2).where("tree = 't'").orderBy("rank").collect()
    assert [r["leaf"] for r in two] == [4, 5]


def test_op2_turns_are_numbered_as_sorted(spark, tmp_path):
    """Null, equal and repeated turns; and no sort brings the texts of a whole conversation together."""
    r = random.Random(4)
    rows = [(r.choice([None, 1, 2, 3]), r.choice([None, None, -5, 0, 1, 2, 40]), r.choice([None, "user", "assistant"]), r.choice([None, "", "a", "b"])) for _ in range(300)]
    rows += [(9, t, "user", str(t)) for t in range(200)]
    path = f"{tmp_path}/conversations"
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5).write.parquet(path)
    df = chat.threads(spark.read.parquet(path))
    low = lambda x: (x is not None, x if x is not None else 0)
    name = lambda x: (x is not None, x or "")
    want = []
    for c in {x[0] for x in rows}:
        own = sorted((x[1:] for x in rows if x[0] == c), key=lambda x: (low(x[0]), name(x[1]), name(x[2])))
        want += [(-(2**63) if c is None else c, i + 1, i or None, role, text) for i, (_, role, text) in enumerate(own)]
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in df.select("tree", "node", "parent", "role", "text").collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(dealt) >= 2 and sum("turn" in line for line in dealt) == len(dealt) - 1  # all by turn, but for the narrow rows of places


def test_op2_report_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (None, 0, "assistant", "a"), (None, 0, "assistant", "a"), (2, None, "assistant", "</s>[INST]")]
    got = {r["conv_id"]: r for r in chat.report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["turns_sha256"], got[1]["loss_chars"]) == (2, sha("user\n\n\nx\n"), 0)
    assert (got[None]["n_turns"], got[None]["loss_sha256"]) == (2, sha("aa")) and got[2]["loss_sha256"] == sha("</s>[INST]")


@pytest.mark.parametrize("f", [rlz.report, rlz.remove, suffix_dedup.report, ngram_join.report, ngram_join.one_each, lm.report])
def test_empty_documents(spark, f):
    assert f(spark.createDataFrame([], DOC)).count() == 0


def test_other_empty_tables(spark):
    e = lambda s: spark.createDataFrame([], s)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert chat.report(e("conv_id long, turn long, role string, text string")).count() == 0
    assert warc.report(e("page_id long, url string, html string")).count() == 0
    assert bpe.encode(e(DOC), path, public_tokenizers.PATTERN).count() == 0
    assert decontaminate.matches(e(DOC), e("item_id long, text string")).count() == 0
    assert vector_dedup.report(e("vec_id long, embedding array<float>")).count() == 0
    assert langid.report(e("doc_id long, text string, lang string")).count() == 0

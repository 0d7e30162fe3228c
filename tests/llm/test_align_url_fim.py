"""Tokenizer alignment, URL filters and fill-in-middle: brute force over whole texts, SQL, edge rows."""

import collections
import hashlib
import os
import random

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sieveline.llm import align, fim, queries, url_filter

DOC = "doc_id long, text string"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.001"

TEXTS = [
    "a b", " a", "a ", "  a  b   ", "don't we'll 12 345", "\n\n  b\tc\n d", "naïve café \U0001f600x", "x　y z", "<|endoftext|> <s></s><unk> [INST]", "▁x", "a▁ b", "", None, " ", "   ",
    "\x1c \x1d a", "ﬁ é", "\x00 b", "日本語 の テスト", "a" * 300, "A B\r\n C", "w " * 500, "end.\n", "x\u2028 y", "ab\u0085 c",
]


def token_bytes():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    of = align.byte_alphabet()
    names = {i: t for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return (
        lambda t: [(i, bytes(of[c] for c in names[i])) for i in a.encode(" " + t, add_special_tokens=False).ids],
        lambda t: [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)],
    )


def brute(rows):
    """Every pair of tokens by its ranges, over whole texts."""
    encode_a, encode_b = token_bytes()
    per, count = [], collections.Counter()
    for _, t in rows:
        x, y = (encode_a(t), encode_b(t)) if t else ([], [])
        if not t or any(b"".join(v for _, v in z) != (" " + t).encode() for z in (x, y)):
            per.append(([], [], []))
            continue
        at = [[0], [0]]
        for z, ends in zip((x, y), at, strict=True):
            for _, v in z:
                ends.append(ends[-1] + len(v))
        links = [(i, j) for i in range(len(x)) for j in range(len(y)) if max(at[0][i], at[1][j]) < min(at[0][i + 1], at[1][j + 1])] if len(x) < 400 else near(at)
        cuts = sorted({*at[0]} & {*at[1]})[1:]
        groups, i, j = [], 0, 0
        for c in cuts:
            i2, j2 = at[0].index(c), at[1].index(c)
            groups.append(",".join(str(v) for v, _ in x[i:i2]) + "|" + ",".join(str(v) for v, _ in y[j:j2]))
            i, j = i2, j2
        pairs = [(y[j][0], x[i][0]) for i, j in links]
        count.update(pairs)
        per.append((x, y, pairs, groups))
    best = collections.defaultdict(int)
    for (b, _), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), p in zip(rows, per, strict=True):
        if not p[0]:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, pairs, groups = p
        out.append((i, len(x), len(y), len(groups), len(pairs), sum(count[q] == best[q[0]] for q in pairs), sum(count[q] for q in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, count


def near(at):
    return [(i, j) for i in range(len(at[0]) - 1) for j in range(len(at[1]) - 1) if at[0][i] < at[1][j + 1] and at[1][j] < at[0][i + 1]]


def rows_of_texts():
    r = random.Random(3)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + k, " ".join(r.choice(["alpha", "beta's", "γάμμα", "12", "x" * 9, "don't", "", "\n"]) for _ in range(r.randrange(60)))) for k in range(60)]
    return rows + [(None, "a b"), (None, "a b"), (-7, "negative id"), (100, rows[-1][1])]


@pytest.mark.parametrize(("chunk", "stripes", "group"), [(align.CHUNK, align.STRIPES, 512), (200, 16, 3)])
def test_op11_against_brute_force(spark, monkeypatch, chunk, stripes, group):
    monkeypatch.setattr(align, "GROUP", group)
    rows = rows_of_texts()
    want, count = brute(rows)
    df = spark.createDataFrame(rows, DOC).withColumns({"chunk": F.lit("x"), "stripe": F.lit(1)}).repartition(3)
    got = [tuple(r) for r in align.report(df, A, B, chunk, stripes).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    table = {(r["b_id"], r["a_id"]): r["n"] for r in align.pair_counts(df, A, B, chunk, stripes).collect()}
    assert table == dict(count)


def test_op11_given_documents(spark):
    """Whole texts of sf0.001, tokenised at once, against units."""
    d = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 3000").select("doc_id", "text").collect()]
    want, _ = brute(d)
    got = [tuple(r) for r in align.report(spark.createDataFrame(d, DOC), A, B).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(d) > 50


def test_op11_many_units(spark, monkeypatch):
    """What a worker remembers is dropped between chunks."""
    monkeypatch.setattr(align, "REMEMBER", 3)
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(40))) for i in range(60)]
    want, _ = brute(rows)
    f = align._packed(A, B, 16, 300)
    import pyarrow as pa

    align.aligner.cache_clear()
    batches = list(f(iter([pa.record_batch([[i for i, _ in rows], [t for _, t in rows]], names=["doc_id", "text"])])))
    work = align.aligner(A, B)
    assert len(batches) > 10 and len(work.text) < 60
    got = []
    for b in batches:
        blob = b.column("docs")[0].as_py()
        n = int.from_bytes(blob[:8], "little")
        ids, _, _, *figures = align._unpress(blob[8 : 8 + n], 7)
        got += list(zip(ids.tolist(), *(x.tolist() for x in figures), strict=True))
    assert sorted(got) == sorted(w[:5] for w in want)


def test_op11_units_are_read_together():
    """As one by one; most plain words are not read alone, and a unit that is not given back costs only those beside it."""
    r = random.Random(7)
    signs = ["a", "b", "e", "n", "ing", "é", "ñ", "日", "\U0001f600", "'s", "-", "12", "\t", "X"]
    plain = list({"".join(r.choices(signs, k=r.randint(1, 9))) + "z" for _ in range(900)})
    odd = ["", "a ", "x\n", "▁x", "x　y", "ﬁ", "\x00"]
    alone, work, one = [], align.Aligner(A, B), align.Aligner(A, B)
    by_one = work._one_by_one
    work._one_by_one = lambda units: (alone.extend(units), by_one(units))
    work._learn(plain)
    assert len(alone) < len(plain) / 2
    work._learn(odd)
    one._one_by_one(plain + odd)
    assert set(work.index) == set(one.index) == {*plain, *odd}

    def told(w, u):
        k = w.index[u]
        return w.text[k], [*w.pairs[w.first[k] : w.first[k + 1]]], [*w.figures[4 * k : 4 * k + 4]], k in w.bad

    assert all(told(work, u) == told(one, u) for u in one.index)


def test_op11_empty(spark):
    assert align.report(spark.createDataFrame([], DOC), A, B).count() == 0
    assert align.pair_counts(spark.createDataFrame([(1, None)], DOC), A, B).count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def same(df, relation):
    names = sorted(df.columns)
    got = sorted(str(tuple(r[c] for c in names)) for r in df.collect())
    columns = [x[0] for x in relation.description]
    assert sorted(columns) == names
    return got == sorted(str(tuple(r[columns.index(c)] for c in names)) for r in relation.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["op12_url_filter", "op13_fill_in_middle"])
def test_query_equals_sql(spark, duck, name):
    assert same(queries.QUERIES[name](spark, DATA), duck.execute(queries.ORACLES[name]))


def urls(seed=1):
    r = random.Random(seed)
    slug = lambda: "".join(r.choice("abcdefghij") for _ in range(8))
    rows = [None, "", "no scheme", "HTTP://ExAmple.ORG", "http://example.org/es/1", "http://notexample.org/es/1", "http://a.EXAMPLE.org/en/12?x=1", "x://org", "http://com/de/", "http://://b/c", "//a.com/fr/", "http://İ.com/fr/x#y", "http://a.com?q/fr/"]
    rows += [f"http://shop.example.net/{slug()}/{k}" for k in range(300)] + [f"http://shop.example.com/de/{slug()}" for _ in range(40)] + [f"http://shop.example.com/{slug()}/a" for _ in range(40)]
    rows += [f"https://news.example.com/{x}/{r.randrange(999)}" for x in ("fr", "de", "en") for _ in range(60)] + ["http://deep.com/" + "/".join("abcdefghijk")] * 30
    rows += [f"https://mix.example.org/{r.choice(['es', 'en', 'it'])}/{r.randrange(30)}{r.choice(['', '/', '.html', '/0123456789abcdef0123'])}" for _ in range(400)]
    return [(i if i % 7 else None, u) for i, u in enumerate(rows)]


def test_op12_equals_sql_on_other_urls(spark, duck):
    rows = urls()
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(0), "segs": F.lit("x"), "html": F.lit(None).cast("string")}).repartition(3)
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url").toPandas().astype({"page_id": "Int64"}))
    got = url_filter.judge(df, queries.RULES)
    assert same(got, con.execute(queries.ORACLES["op12_url_filter"])) and got.count() == len(rows)


def test_op12_rules(spark):
    want = {
        "HTTP://ExAmple.ORG": ("example.org", "", None), "http://example.org/": ("example.org", "/", "org/"), "http://example.org/es/1": ("example.org", "/es/1", "example.org/es/"),
        "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/"), "http://a.EXAMPLE.org/en/12?x=1": ("a.example.org", "/en/12", "example.org/en/1"), "http://com/de/": ("com", "/de/", "com/de/"),
        "http://://b/c": (":", "//b/c", None), "no scheme": ("", "", None), None: ("", "", None), "http://a.com?q/fr/": ("a.com", "", None), "http://acom/fr/": ("acom", "/fr/", None),
    }
    got = url_filter.judge(spark.createDataFrame([(1, u) for u in want], "page_id long, url string").withColumn("u", F.col("url")), queries.RULES)
    rows = collections.Counter(tuple(r)[1:4] for r in got.collect())
    assert rows == collections.Counter(want.values())
    assert {r["rule"]: r["verdict"] for r in got.where("rule is not null").collect()} == {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/de/": "block"}


def test_op12_tree(spark):
    """Rare children become one template, common ones stay; branches that differ have purities of their own."""
    r = random.Random(2)
    slug = lambda: "".join(r.choice("abcdefghij") for _ in range(9))
    rows = [(0, f"http://h.example/user/{slug()}", 1) for _ in range(40)] + [(0, f"http://h.example/news/{k}", 0) for k in range(40)] + [(0, f"http://h.example/blog/{k}", None) for k in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, spam int")
    t = {x["node"]: x for x in url_filter.templates(df, [], F.col("spam")).groupBy("node").agg(F.sum("n").alias("n"), F.max("purity").alias("purity")).collect()}
    assert {k: v["n"] for k, v in t.items()} == {"/user/*": 40, "/news/{n}": 40, "/blog/{n}": 10}
    assert t["/user/*"]["purity"] > 0.8 and t["/news/{n}"]["purity"] < 0.2 and 0.3 < t["/blog/{n}"]["purity"] < 0.7
    verdict = {x["path"].split("/")[1]: x["verdict"] for x in url_filter.judge(df, [], F.col("spam")).collect()}
    assert verdict["user"] == "block" and verdict["news"] == "allow"
    assert {x["verdict"] for x in url_filter.judge(df, []).collect()} == {"allow"}  # nothing labelled
    assert url_filter.judge(df.limit(0), queries.RULES).count() == 0


def test_op12_is_native(spark):
    plan = queries.QUERIES["op12_url_filter"](spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def units(text):
    out, i, space = [], 0, " \t\n\x0b\x0c\r"
    while i < len(text):
        j = i
        while j < len(text) and text[j] in space:
            j += 1
        while j < len(text) and text[j] not in space:
            j += 1
        out.append(text[i:j])
        i = j
    return out


def test_op13_against_brute_force(spark):
    r = random.Random(8)
    rows = [(i, "".join(r.choice(["a", "é", " ", "\n", "\u3000", "\x85", "<", "P>", "<M", "\U0001f600", "word ", "\t\t"]) for _ in range(r.randrange(80)))) for i in range(400)]
    rows += [(None, "some text here"), (None, "some text here"), (500, None), (501, ""), (502, "has <S> in it " * 5), (503, " \n "), (504, "w " * 300_000)]
    df = spark.createDataFrame(rows, DOC).withColumns({"n": F.lit("x"), "form": F.lit(0)}).repartition(5)
    want = []
    for i, t in rows:
        t = t or ""
        u, h = units(t), hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        pre, mid, suf = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
        plain = not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50
        form = "plain" if plain else "spm" if h4 % 100 < 80 else "psm"
        out = {"plain": t, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(u), form, None if plain else len(pre), None if plain else len(mid), sha(out), sha(t)))
    assert sorted(str(tuple(r)) for r in fim.report(df).collect()) == sorted(map(str, want))
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fim.report(df.limit(0)).count() == 0


def test_op13_holds_no_list_of_units():
    """Memory of a long text with very many units stays that of the text and its output."""
    import re
    import tracemalloc

    text = "ab " * 400_000
    units = re.compile(fim.UNITS)
    tracemalloc.start()
    n = fim.count(units, text)
    fim.borders(units, text, n // 3, n - 1)
    assert tracemalloc.get_traced_memory()[1] < 100_000
    tracemalloc.stop()
    assert n == 400_001

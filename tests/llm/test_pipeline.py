"""The pipeline against a brute-force version of its five stages, and its stages on awkward rows."""

import base64
import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def shingles(t):
    w = t.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(t):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", t.lower()).split()


def brute(docs, items):
    docs = {i: t for i, t in docs.items() if t and regex.search(r"\p{L}", t)}
    ids = sorted(docs)
    sets = {i: shingles(docs[i]) for i in ids}
    kept, group = [], {}
    for i in ids:
        if i in group:
            continue
        kept.append(i)
        todo, group[i] = [i], i
        while todo:
            a = todo.pop()
            for b in ids:
                if b not in group and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    group[b] = i
                    todo.append(b)
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", docs[i]) for i in kept}
    count = collections.Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    texts = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        texts[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else docs[i]
    leaks = [f" {' '.join(plain(t))} " for t in items if len(plain(t)) >= 5]
    texts = {i: t for i, t in texts.items() if not any(x in f" {' '.join(plain(t))} " for x in leaks)}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}  # noqa: SIM115
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, t in texts.items():
        n = enc.encode_ordinary(t)
        yield i, len(n), hashlib.sha256(np.array(n, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()


def test_run_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, DATA).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, items))


def test_stages_on_awkward_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "some words here", None, "s", 5), (3, "some words here", "en", "s", 5), (3, "some words here", "en", "s", 5), (4, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1)).withColumn("k1", F.lit("x"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns
    assert [r["doc_id"] for r in docs.collect()] == [3]
    assert [r["n_tokens"] for r in corpus_pipeline.tokens(spark, docs, DATA).collect()] == [3]

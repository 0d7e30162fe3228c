"""The registered queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import align, bpe, chat, decontaminate, fim, langid, lm, ngram_join, rlz, suffix_dedup, url_filter, vector_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.report(_table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -1L AS conv_id, t AS turn, r AS role, s AS text FROM VALUES (0L, 'user', :said), (1L, 'assistant', :said) AS v(t, r, s)", args={"said": said})
    return chat.report(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(_table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.report(_table(spark, sf_dir, "documents"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False, remember=600_000)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.report(_table(spark, sf_dir, "embeddings"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


RULES = (
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"),
)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), RULES)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_rlz_dedup, op2_chat_format, op3_suffix_dedup, op4_ngram_join, op5_lm_scores, op6_warc_zip, op7_bpe, op8_decontaminate, op9_vector_dedup, op10_langid,
        op11_tokenizer_alignment, op12_url_filter, op13_fill_in_middle,
    )
}

#: Words by explicit code points; a window is its words joined by one space.
_OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i:i+34], ' ')) AS h FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
dup AS (SELECT rid, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT rid, i + j AS p FROM dup, unnest(range(0, 35)) AS t(j)),
cut AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid),
pos AS (SELECT rid, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS left_text FROM pos
  ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(left_text, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (rid) LEFT JOIN kept USING (rid)
"""

#: Two hex digits a byte; a text is cut into chunks of 4,000 bytes and 399 of the next, so that a window is found fast.
_OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
ch AS (SELECT rid, o, substr(x, 2 * o + 1, 2 * 4399) AS c FROM d, unnest(range(0, length(x) // 2, 4000)) AS t(o)),
win AS (SELECT rid, o + j AS i, md5_number(substr(c, 2 * j + 1, 800)) AS h FROM ch, unnest(range(0, least(4000, length(c) // 2 - 399))) AS t(j)),
dup AS (SELECT rid, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
edge AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER w + 400 THEN 0 ELSE 1 END AS new FROM dup WINDOW w AS (PARTITION BY rid ORDER BY i)),
isl AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM edge),
span AS (SELECT rid, min(i) AS a, max(i) + 400 AS b FROM isl GROUP BY rid, k),
gone AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY rid),
stop AS (SELECT rid, a, b FROM span UNION ALL SELECT rid, length(x) // 2, length(x) // 2 FROM d),
gap AS (SELECT rid, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a, b), 0) AS lo, a AS hi FROM stop),
kept AS (SELECT g.rid, string_agg(substr(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS left_hex FROM gap g JOIN d USING (rid) GROUP BY g.rid)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(left_hex)) AS kept_sha256
FROM d JOIN kept USING (rid) LEFT JOIN gone USING (rid)
"""

#: A control string grows by one sign, a backslash by one, a line end in a role by one.
_OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(x.text) + length(regexp_extract_all(x.text, '<\|(?:im_start|im_end|endoftext)\|>|</?s>|<</?SYS>>|\[/?INST\]|\\'))
              AS text_chars,
         length(x.role) + length(regexp_extract_all(x.role, '<\|(?:im_start|im_end|endoftext)\|>|</?s>|<</?SYS>>|\[/?INST\]|\\|\n'))
              AS role_chars
  FROM c x)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + role_chars + 1 + text_chars + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: Base 32 of the 160 bits of a SHA-1: 32 digits of 5 bits each.
_OP6 = r"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
b AS (
  SELECT rid, string_agg(lpad(bin(instr('0123456789abcdef', substr(sha, i, 1)) - 1), 4, '0'), '' ORDER BY i) AS bits
  FROM p, unnest(range(1, 41)) AS t(i) GROUP BY rid),
d AS (
  SELECT rid, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(substr(bits, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * k + 2, 1) AS INT)
             + 4 * CAST(substr(bits, 5 * k + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * k + 4, 1) AS INT)
             + CAST(substr(bits, 5 * k + 5, 1) AS INT), 1), '' ORDER BY k) AS digest
  FROM b, unnest(range(0, 32)) AS t(k) GROUP BY rid),
m AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS last FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM m JOIN d USING (rid)
"""

#: Brute force over all pairs that share a shingle.
_OP4 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT rid, md5_number(array_to_string(w[i:i+4], ' ')) AS h
  FROM d, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 3, 2) END)) AS t(i)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.rid <> b.rid GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE shared >= 0.8 * (x.n + y.n - shared)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a, min(doc_id) AS class_id FROM reach JOIN d ON d.rid = reach.b GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM d JOIN c ON c.a = d.rid LEFT JOIN k ON k.a = d.rid
"""

#: Brute force over all pairs.
_OP9 = r"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
f AS (
  SELECT * FROM e
  WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND list_dot_product(x, x) > 0),
link AS (
  SELECT a.rid AS a, b.rid AS b FROM f a JOIN f b ON a.rid <> b.rid AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.9),
reach AS (SELECT rid AS a, rid AS b FROM e UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN e ON e.rid = reach.b GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN c ON c.a = e.rid LEFT JOIN k ON k.a = e.rid
"""

#: Units as a list; digits of the hash by groups of eight.
_OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 >= 50 AS plain,
         CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 < 80 AS spm FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(u[greatest(c1, c2) + 1:n], '') AS suf FROM h)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(pre) END AS prefix_chars, CASE WHEN NOT plain THEN length(mid) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def _op12() -> str:
    """The tree level by level: g are the paths with their nodes, k a level's children, q their purities."""
    u = url_filter
    fits = " UNION ALL ".join(f"SELECT '{r.host}' AS rh, '{r.path}' AS rp, '{r.verdict}' AS rv" for r in RULES)
    head = rf"""
WITH r AS ({fits}),
p AS (
  SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(url, ''), '{u.URL}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '{u.URL}', 2) AS path FROM pages),
m AS (
  SELECT rid, arg_max(rh || rp, length(rh || rp) * 1000 + length(rh)) AS rule, arg_max(rv, length(rh || rp) * 1000 + length(rh)) AS ruling
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY rid),
f AS (
  SELECT *, CASE WHEN len(every) > {u.DEPTH} THEN list_append(every[1:{u.DEPTH}], '**') ELSE every END AS segs FROM (
    SELECT page_id, host, path, rule, ruling, list_transform(string_split(regexp_replace(path, '^/', ''), '/'),
      lambda s: CASE WHEN regexp_full_match(s, '[0-9a-fA-F-]{{16,}}') THEN '{{x}}' ELSE regexp_replace(s, '[0-9]+', '{{n}}', 'g') END) AS every
    FROM p LEFT JOIN m USING (rid))),
g0 AS (SELECT host, segs, '' AS node, [''] AS path_nodes, count(*) AS n, count(ruling) AS l, count(*) FILTER (WHERE ruling = 'block') AS b FROM f GROUP BY host, segs),
c AS (SELECT coalesce(sum(b) / nullif(sum(l), 0), 0) AS corpus FROM g0)"""
    parts, depth = [head], u.DEPTH + 1
    for i in range(1, depth + 1):
        parts.append(f"""
s{i} AS (SELECT host, node, segs[{i}] AS seg, sum(n) AS kid FROM g{i - 1} WHERE len(segs) >= {i} GROUP BY ALL HAVING sum(n) < {u.COMMON}),
v{i} AS (SELECT host, node FROM s{i} GROUP BY ALL HAVING count(*) >= {u.KIDS}),
w{i} AS (SELECT host, node, seg FROM s{i} JOIN v{i} USING (host, node)),
g{i} AS MATERIALIZED (
  SELECT g.host, segs, CASE WHEN len(segs) < {i} THEN g.node ELSE g.node || '/' || CASE WHEN w.seg IS NULL THEN segs[{i}] ELSE '*' END END AS node,
         CASE WHEN len(segs) < {i} THEN path_nodes ELSE list_append(path_nodes, g.node || '/' || CASE WHEN w.seg IS NULL THEN segs[{i}] ELSE '*' END) END AS path_nodes, n, l, b
  FROM g{i - 1} g LEFT JOIN w{i} w ON w.host = g.host AND w.node = g.node AND w.seg = g.segs[{i}])""")
    parts.append(f"q0 AS (SELECT host, '' AS node, sum(l) AS l, sum(b) AS b, (sum(b) + {u.WEIGHT} * corpus) / (sum(l) + {u.WEIGHT}) AS purity FROM g{depth}, c GROUP BY host, corpus)")
    for i in range(1, depth + 1):
        parts.append(f"""
k{i} AS (
  SELECT x.*, q.purity AS above, coalesce(q.b > 0 AND q.b < q.l AND x.l > 0 AND q.l > x.l AND abs(x.b / nullif(x.l, 0) - (q.b - x.b) / nullif(q.l - x.l, 0))
         >= {u.Z} * sqrt(q.b / nullif(q.l, 0) * (1 - q.b / nullif(q.l, 0)) * (1 / nullif(x.l, 0) + 1 / nullif(q.l - x.l, 0))), FALSE) AS apart
  FROM (SELECT host, path_nodes[{i}] AS parent, path_nodes[{i + 1}] AS node, sum(l) AS l, sum(b) AS b FROM g{depth} WHERE len(path_nodes) > {i} GROUP BY ALL) x
  JOIN q{i - 1} q ON q.host = x.host AND q.node = x.parent),
o{i} AS (SELECT host, parent, sum(l) AS l, sum(b) AS b FROM k{i} WHERE NOT apart GROUP BY ALL),
q{i} AS (
  SELECT k.host, k.node, k.l, k.b, CASE WHEN apart THEN (k.b + {u.WEIGHT} * above) / (k.l + {u.WEIGHT}) ELSE (o.b + {u.WEIGHT} * above) / (o.l + {u.WEIGHT}) END AS purity
  FROM k{i} k LEFT JOIN o{i} o ON o.host = k.host AND o.parent = k.parent)""")
    every = " UNION ALL ".join(f"SELECT host, node, purity FROM q{i}" for i in range(depth + 1))
    parts.append(f"z AS (SELECT g.host, g.segs, q.purity FROM g{depth} g JOIN ({every}) q ON q.host = g.host AND q.node = g.node)")
    return ",\n".join(parts) + f"""
SELECT page_id, f.host, path, rule, coalesce(ruling, CASE WHEN purity >= {u.REJECT} - 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN z ON z.host = f.host AND z.segs = f.segs
"""


ORACLES = {
    "op1_rlz_dedup": _OP1, "op2_chat_format": _OP2, "op3_suffix_dedup": _OP3, "op4_ngram_join": _OP4, "op6_warc_zip": _OP6, "op9_vector_dedup": _OP9, "op12_url_filter": _op12(), "op13_fill_in_middle": _OP13,
}

"""The operators applied to whole tables, as queries opN_<name> and pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, decontaminate, fingerprints, language, packing, pii, repair, repeats, resampling, simhash, toxicity, transcripts, urls
from .words import fold

TOKENIZER = "word_bpe_49k.json"

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[f.__name__] = f
    return f


LLM_QUERIES["pipeline"] = corpus_pipeline.run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2048, 0, with_ids=False)


@_query
def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = bitpack.write_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 1)
    return bitpack.read_ids(files, digests_only=True)


@_query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, bits=2)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    known = labels.where(fold("doc_id", 5) != 0).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.train(known, docs))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         "predicted", "n_toxic_words", "spans")


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    known = docs.where((fold("doc_id", 4) != 2) & F.col("lang").isNotNull())
    model = language.train(known.select(F.col("doc_id").alias("id"), F.col("lang").alias("label")), docs)
    return language.predict(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@_query
def op2_version_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.version_fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"].cast("int"))
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


@_query
def op10_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove(_table(spark, sf_dir, "documents"), 100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


LLM_SQL["op10_repeat_removal"] = """
WITH d AS (SELECT doc_id, b, hex(b) AS h, octet_length(b) AS n FROM (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents) t),
w AS (SELECT doc_id, p, b[p:p + 99] AS s FROM (SELECT doc_id, b, unnest(generate_series(1, n - 99)) AS p FROM d) t),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
i AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM i),
x AS (SELECT doc_id, min(p) AS a, max(p) + 99 AS z FROM g GROUP BY doc_id, k),
y AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM x),
c AS (SELECT doc_id, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - 1 - before) AS BIGINT)), '' ORDER BY a) AS kept,
  max(z) AS last, sum(z - a + 1) AS gone, count(*) AS spans FROM y JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, CAST(2 * last + 1 AS BIGINT)), h))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)"""


def marked_transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts in five styles of speaker markers; one turn in eight has none."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    name = F.when(F.col("role") == "user", F.element_at(F.array(*map(F.lit, ("User", "Human", "user", "Q", "Customer"))), style.cast("int") + 1)) \
        .when(F.col("role") == "assistant", F.element_at(F.array(*map(F.lit, ("Assistant", "AI", "assistant", "A", "Agent"))), style.cast("int") + 1)) \
        .otherwise("System")
    mark = F.when(style == 1, F.concat(F.lit("### "), name, F.lit("\n"))).when(style == 2, F.concat(F.lit("<|"), name, F.lit("|>\n"))) \
        .when(style == 4, F.concat(F.lit("**"), name, F.lit("**: "))).otherwise(F.concat(name, F.lit(": ")))
    bare = (F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(8)) == 0) | F.col("role").isNull()
    return conversations.withColumn("text", F.concat(F.when(bare, "").otherwise(mark), F.coalesce("text", F.lit(""))))


@_query
def op8_transcript_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marked_transcripts(_table(spark, sf_dir, "conversations"))
    found = transcripts.parse(rows, "conv_id", "turn", "text", "role", fold("conv_id", 4) != 0)
    return found.select(F.col("id").alias("conv_id"), "first_line", "begins", "role", "n_lines", "rendered")


#: Rules that pages are judged by: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@_query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules)


LLM_SQL["op11_url_filter"] = """
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
s AS (SELECT row_number() OVER () AS k, page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
m AS (SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (k)"""

#: CRC-32 of the UTF-8 bytes of {w}, with tab(t) the table of all bytes.
_CRC_TABLE = """tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode({w}))),
  lambda i: CAST('0x' || substr(hex(encode({w})), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


@_query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
LLM_SQL["op12_importance_resampling"] = f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT k, w, count(*) AS n FROM (SELECT k, unnest(ws) AS w FROM d) x GROUP BY k, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) x GROUP BY w),
words AS (SELECT w, {_CRC.format(w='w')} % 10000 AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw) x, tab),
s AS (SELECT b, sum(n) AS n FROM dw JOIN words USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM bw JOIN words USING (w) GROUP BY b),
g AS (SELECT i.b AS b, floor(1000 * ln((coalesce(t.n, 0) + 1) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE)
  / ((coalesce(s.n, 0) + 1) * CAST((SELECT sum(n) FROM t) + 10000 AS DOUBLE)))) AS gain
  FROM (SELECT unnest(range(10000)) AS b) i LEFT JOIN s ON s.b = i.b LEFT JOIN t ON t.b = i.b),
m AS (SELECT k, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM dw JOIN words USING (w) JOIN g USING (b) GROUP BY k),
f AS (SELECT k, doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN m USING (k)),
o AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id, k) AS place FROM f WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM o) * 10 // 100 THEN place END AS rank FROM f LEFT JOIN o USING (k)"""


@_query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_report(_table(spark, sf_dir, "conversations"))


LLM_SQL["op13_conversation_repair"] = f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS w FROM conversations),
dealt AS (SELECT *, {_CRC.format(w='w')} % 20 AS k FROM given, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE k <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM damaged),
known AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, substr(role, 1, 1) AS i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM numbered),
r AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN again THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM known),
ins(q, letters, cost, state, said) AS (VALUES (0, '', 0, 0, CAST([] AS VARCHAR[])), (1, '', 0, 1, []), (2, '', 0, 2, []), (3, '', 0, 3, []),
  (0, 'I', 5, 2, ['user:']), (1, 'I', 5, 2, ['user:']), (3, 'I', 5, 2, ['user:']), (2, 'I', 5, 3, ['assistant:']),
  (0, 'II', 10, 3, ['user:', 'assistant:']), (1, 'II', 10, 3, ['user:', 'assistant:']), (3, 'II', 10, 3, ['user:', 'assistant:']),
  (2, 'II', 10, 2, ['assistant:', 'user:'])),
kept(state, i, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
way(state, letter, next, i) AS (SELECT state, 'K', next, i FROM kept UNION ALL SELECT * FROM (VALUES (0, 'R', 2, NULL), (1, 'R', 2, NULL), (3, 'R', 2, NULL),
  (2, 'R', 3, NULL), (0, 'D', 0, NULL), (1, 'D', 1, NULL), (2, 'D', 2, NULL), (3, 'D', 3, NULL)) v),
path(conv_id, n, q, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} FROM r
  UNION ALL
  SELECT path.conv_id, path.n + 1, next, min({{'c': best.c + cost + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 't' THEN 5 ELSE 0 END,
    'a': best.a || letters || letter, 't': list_concat(best.t, said, CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
    ELSE [CASE next WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END)}})
  FROM path JOIN r ON r.conv_id IS NOT DISTINCT FROM path.conv_id AND r.n = path.n + 1 JOIN ins USING (q) JOIN way ON way.state = ins.state
  WHERE (letter = 'D' OR fault NOT IN ('b', 'd')) AND (way.i IS NULL OR way.i = r.i) GROUP BY path.conv_id, path.n, next),
done AS (SELECT path.conv_id, min({{'c': best.c + cost, 'a': best.a || letters, 't': list_concat(best.t, said)}}) AS best
  FROM path JOIN (SELECT conv_id, max(n) AS n FROM r GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM path.conv_id AND l.n = path.n
  JOIN ins USING (q) WHERE state IN (0, 3) GROUP BY path.conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT o.conv_id AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id"""

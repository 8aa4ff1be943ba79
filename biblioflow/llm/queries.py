"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.llm import backoff_lm, chat, dac, decontam, hilbert, langid, packing, repetition, resampling, simhash, toxicity, url_filter, whitening
from biblioflow.llm.common import crc_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(documents, labels, crc_fold(F.col("doc_id"), 3) != 1)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = toxicity.scored(documents, toxicity_model(documents, _table(spark, sf_dir, "labels")))
    held_out = (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = hilbert.write(_table(spark, sf_dir, "documents"), ["source", "lang", "n_chars", "doc_id"], law="rows")
    text_crc32 = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return laid.select("doc_id", hilbert.size_of(F.col("text")).alias("size"), text_crc32.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


URL_RULES = (
    url_filter.Rule(False, "com", "/en/"),
    url_filter.Rule(True, "example.com", "/en/7"),
    url_filter.Rule(True, "net", "/de/"),
    url_filter.Rule(False, "example.net", "/de/8"),
    url_filter.Rule(False, "org", "/es/"),
)


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.judged(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), trap.alias("text"))
    found = chat.formatted(given.unionByName(extra))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    found = found.withColumn("loss", F.array_join(chat.under_mask(F.col("formatted"), F.col("loss_spans")), ""))
    loss = F.col("loss")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packed.drop("ids")


def op7_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read(dac.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def language_network(documents: DataFrame) -> langid.Network | None:
    return langid.train(documents, crc_fold(F.col("doc_id"), 4) != 2)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = langid.predicted(documents, language_network(documents))
    return found.select("doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_fold(F.col("doc_id"), 5) == 1
    found = backoff_lm.scored(_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_hilbert": op2_hilbert,
    "op3_urls": op3_urls,
    "op4_repetition": op4_repetition,
    "op5_chat": op5_chat,
    "op6_packing": op6_packing,
    "op7_dac": op7_dac,
    "op8_decontam": op8_decontam,
    "op9_simhash": op9_simhash,
    "op10_langid": op10_langid,
    "op11_backoff_lm": op11_backoff_lm,
    "op12_whitening": op12_whitening,
    "op13_resampling": op13_resampling,
}

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT dw.doc_id, item_id, p, dw.k FROM dw JOIN iw ON dw.s = iw.s AND dw.k = iw.k),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS h FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
win AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (VALUES (6), (8)) AS ks(k) WHERE len(w) >= k)),
rep AS (SELECT doc_id, k, p FROM (SELECT doc_id, k, p, count(*) OVER (PARTITION BY doc_id, k, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, k, count(DISTINCT q) AS n FROM (SELECT doc_id, k, unnest(range(p, p + k)) AS q FROM rep) GROUP BY ALL),
far AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, md5(array_to_string(list_slice(w, p, p + 200), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 199)) AS p FROM d JOIN cov USING (doc_id) WHERE k = 6 AND n > 200 AND len(w) > 200)) GROUP BY doc_id, s HAVING count(*) > 1),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(b.n, 0) AS BIGINT) AS covered_words, far.doc_id IS NOT NULL AS is_far
  FROM d LEFT JOIN lines ON lines.doc_id = d.doc_id LEFT JOIN cov a ON a.doc_id = d.doc_id AND a.k = 8 LEFT JOIN cov b ON b.doc_id = d.doc_id AND b.k = 6 LEFT JOIN far ON far.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND covered_words <= CAST(0.3 AS DOUBLE) * n_words AND NOT is_far AS kept FROM m
"""

OP5_SQL = r"""
WITH trap AS (SELECT '\### Assistant: </turn> ok' AS s),
src AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', s FROM trap UNION ALL SELECT -7, 1, 'assistant', s FROM trap),
c AS (SELECT *, regexp_matches(x, '</?turn>|\\[\\ln]') OR regexp_matches(r, '</?turn>|\\[\\ln]') OR contains(r, chr(10)) AS hard FROM src),
n AS (SELECT *, length(r) + length(x) + 15 + CASE WHEN hard THEN length(regexp_replace(r, '[^\\<\n]', '', 'g')) + length(regexp_replace(x, '[^\\<]', '', 'g')) ELSE 0 END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, true AS identical
FROM n GROUP BY conv_id
"""

OP13_SQL = r"""
WITH tab AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) r(b)),
src AS (SELECT 0 AS kind, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
d AS (SELECT kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM src),
f AS (SELECT kind, doc_id, unnest(w) AS f FROM d UNION ALL SELECT kind, doc_id, w[p] || ' ' || w[p + 1] FROM (SELECT kind, doc_id, w, unnest(range(1, len(w))) AS p FROM d)),
g AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
b AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: 16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM g, tab),
n AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM f JOIN b USING (f) GROUP BY 1),
n2 AS (SELECT *, sum(s) OVER () AS all_s, sum(t) OVER () AS all_t FROM n),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS g FROM n2),
m AS (SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM f JOIN b USING (f) JOIN gain USING (bucket) WHERE kind = 0 GROUP BY 1),
z AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 WHEN g >= 0 THEN g // n ELSE -((n - 1 - g) // n) END AS weight,
  CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (doc_id) WHERE kind = 0),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM z),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS total FROM y WHERE n_words >= 20)
SELECT y.doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN k <= 25 * total // 100 THEN k END AS rank FROM y LEFT JOIN r USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_repetition": OP4_SQL,
    "op5_chat": OP5_SQL,
    "op8_decontam": OP8_SQL,
    "op13_resampling": OP13_SQL,
}

"""The registered queries of this subpackage: thin, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import ann, bpe, exact_dedup, html_text, importance, langid, lexical, licenses, line_dedup, packing, quality, simhash, token_counts
from rowloom.llm.tables import table


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), common AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS lost FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.license_scan(table(spark, sf_dir, "documents"))
    best = F.get("hits", F.lit(0))
    return out.select("doc_id", "license", "score", "n_licenses", best["start"].alias("start"), best["end"].alias("end"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 by table: a byte's part depends on how many bytes follow (`far`), and parts are combined by exclusive or.
OP12_SQL = f"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), step AS (
  SELECT b, v FROM bits WHERE k = 8
), words AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
  UNION ALL SELECT 'b', item_id, unnest(w), generate_subscripts(w, 1)
  FROM (SELECT item_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
), runs AS (
  SELECT kind, id, word AS feature FROM words
  UNION ALL SELECT a.kind, a.id, a.word || ' ' || b.word FROM words a JOIN words b ON a.kind = b.kind AND a.id = b.id AND b.pos = a.pos + 1
), named AS (
  SELECT feature, hex(encode(feature)) AS h, octet_length(encode(feature)) AS n FROM (SELECT DISTINCT feature FROM runs)
), far(d, b, v) AS (
  SELECT 0, b, v FROM step
  UNION ALL SELECT d + 1, f.b, xor(f.v >> 8, s.v) FROM far f JOIN step s ON s.b = f.v & 255 WHERE d + 1 < (SELECT max(n) FROM named)
), begun(n, v) AS (
  SELECT 0, 4294967295
  UNION ALL SELECT n + 1, xor(g.v >> 8, s.v) FROM begun g JOIN step s ON s.b = g.v & 255 WHERE n < (SELECT max(n) FROM named)
), bytes AS (
  SELECT feature, n, ('0x' || h[i : i + 1])::BIGINT AS b, n - 1 - (i - 1) // 2 AS d FROM (SELECT feature, n, h, unnest(range(1, 2 * n, 2)) AS i FROM named)
), bucketed AS (
  SELECT feature, xor(xor(x.v, g.v), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, n, bit_xor(f.v) AS v FROM bytes JOIN far f USING (d, b) GROUP BY feature, n) x JOIN begun g USING (n)
), counted AS (
  SELECT kind, id, bucket FROM runs JOIN bucketed USING (feature)
), totals AS (
  SELECT count(*) FILTER (kind = 'd')::DOUBLE AS s, count(*) FILTER (kind = 'b')::DOUBLE AS t FROM counted
), gains AS (
  SELECT bucket, floor(1000 * ln((count(*) FILTER (kind = 'b') + 1)::DOUBLE * (any_value(s) + 10000) / ((count(*) FILTER (kind = 'd') + 1)::DOUBLE * (any_value(t) + 10000))))::BIGINT AS gain
  FROM counted, totals GROUP BY bucket
), weighed AS (
  SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS total FROM counted JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce((total - (total % n_features + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise,
         (SELECT count(*) FROM words w WHERE w.kind = 'd' AND w.id = doc_id) >= 20 AS drawable
  FROM documents LEFT JOIN weighed ON id = doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY drawable ORDER BY weight + noise DESC, doc_id) AS rn FROM scored
)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN drawable AND rn <= 25 * (SELECT count(*) FROM ranked WHERE drawable) // 100 THEN rn END AS rank
FROM ranked
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


QUERIES = {
    "op1_learned_partitions": op1_learned_partitions,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op7_html_text": op7_html_text,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_license_scan": op10_license_scan,
    "op11_language_id": op11_language_id,
    "op12_importance": op12_importance,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE_SQL = {"op2_line_dedup": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op12_importance": OP12_SQL, "op13_lexical_search": OP13_SQL}

"""Line deduplication across documents.

Lines are normalised to keys and hashed once, and the hashes written. They are exploded, made distinct within each document
and counted over documents, both with map-side partial sums, and those over the threshold are joined back to the
lines by a filter of their own, so that other lines are not shuffled. What comes out are positions to drop. Only the texts
that have some are moved, split and put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.rows import filter_of, located, new_name, passing, row_key
from rowloom.llm.tables import written

#: White space stripped at both ends of a line.
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(trimmed(line), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    """128 bits: two XXH64 of unlike seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def _hashes(text: Column, least: int) -> Column:
    """The hash of each line in order; null for a line whose key is shorter than `least` code points. Lower-casing
    leaves lengths alone, so short lines are spared it; the one-element array has each key made once for both hashes."""

    def one(line: Column) -> Column:
        hashed = F.get(F.transform(F.array(line_key(line)), key_hash), F.lit(0))
        return F.when(F.length(trimmed(line)) >= least, hashed)

    return F.transform(F.split(text, "\n", -1), one)


def line_dedup(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """One row per input row: doc_id, n_lines (before), n_dropped, text (what is left).

    A key of `least_chars` code points or more that stands in `least_docs` documents or more loses all its lines except
    in the largest doc_id that holds it. Other lines stay in their order, joined by newlines. A null or empty text is
    one empty line. Rows of one doc_id count as one document; a row with a null doc_id counts as no document and loses
    its common lines to the others. An empty table gives an empty result. Columns other than doc_id and text are not
    looked at."""
    docs, key = located(docs), new_name("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), row_key(docs).alias(key))
    hashed = written(rows.select(key, "doc_id", _hashes(F.col("text"), least_chars).alias("hashes")), "line-hashes")
    per_doc = hashed.select("doc_id", F.explode(F.filter("hashes", lambda h: h.isNotNull())).alias("h")).distinct()  # lines of a document, rows of a doc_id count once
    common = per_doc.groupBy("h").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
    # a hot line is one key of the join below; as its other side is a table of its own, adaptive execution can split it
    common = written(common.where(F.col("n_docs") >= least_docs), "common-lines")
    lines = hashed.select(key, "doc_id", F.posexplode("hashes").alias("pos", "h")).where("h IS NOT NULL")
    lost = passing(lines, "h", filter_of(common, "h")).join(common, "h").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = written(lost.groupBy(key).agg(F.collect_list("pos").alias("gone")), "lost-lines")
    words, split = filter_of(gone, key), F.split("text", "\n", -1)
    whole = passing(rows, key, words, others=True).select("doc_id", F.size(split).cast("long").alias("n_lines"), F.lit(0).alias("n_dropped"), "text")
    parts = passing(rows, key, words).select(key, "doc_id", split.alias("lines")).join(gone, key, "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    cut = parts.select("doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(stay)).alias("n_dropped"), kept.alias("text"))
    return whole.unionByName(cut)

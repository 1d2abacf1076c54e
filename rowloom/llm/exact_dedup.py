"""Exact deduplication with keyed streaming state.

Documents arrive as a stream of (digest, doc_id, locator). The locator says where a row's content lies, its file and its
number there, and names the row: it is the same however often the row is read. A streaming aggregation keeps one state
entry per digest in RocksDB, without watermark or expiry: the winning row (largest doc_id) with its locator, and how many
rows have come. The state is then read back as a table. A digest with more than one row is a hit; the full texts of its
rows are fetched by their locators and compared before it is believed.

Everything is a DataFrame operation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.rows import filter_of, located, new_name, passing, place, without
from rowloom.llm.tables import scratch, written

#: Files of earlier batches that are read at once.
FILES = 1_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVALS = "digest binary, text_sha256 string, doc_id long, locator struct<file: string, row: long>, n_bytes long, batch string"


def content_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes."""
    return F.unhex(F.sha2(text, 256))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def arrivals(docs: DataFrame, digest=content_digest, batch: str = "") -> DataFrame:
    """What the state needs of each row, see ARRIVALS."""
    docs = located(docs)
    return docs.select(
        digest(_text()).alias("digest"),
        F.sha2(_text(), 256).alias("text_sha256"),
        F.col("doc_id").cast("long").alias("doc_id"),
        place(docs).alias("locator"),
        F.octet_length(_text()).cast("long").alias("n_bytes"),
        F.lit(batch).alias("batch"),
    )


def keyed_state(stream: DataFrame) -> DataFrame:
    """The streaming aggregation whose state is the set of contents seen so far. No watermark: nothing expires."""
    return stream.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("winner"), F.count(F.lit(1)).alias("n_rows"))


def absorb(spark: SparkSession, source: str, schema, checkpoint: str, files_per_batch: int = 256) -> None:
    """Take all files of arrivals that are at source and not yet in the state into it. May be called again as more
    files come: the checkpoint knows which have been read."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # many small stores: no preallocated files in each
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # one cache and one bound for all stores of an executor, and write buffers that suit their size: else each store has its own,
    # outside the heap, and they are not unloaded before later stages
    for name, value in (("boundedMemoryUsage", "true"), ("maxMemoryUsageMB", "128"), ("writeBufferSizeMB", "4")):
        own.conf.set(f"spark.sql.streaming.stateStore.rocksdb.{name}", value)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        keyed_state(stream.select("digest", "doc_id", "locator"))
        .writeStream.outputMode("update").format("noop")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, winner (doc_id, locator), n_rows."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.digest", F.col("value.max").alias("winner"), F.col("value.count").alias("n_rows"))


def _contents(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """locator, text of the rows that hits name, from docs and, for those of earlier batches, from the files that their
    locators name. Only rows that pass the filter of the locators are shuffled."""
    spark, found = docs.sparkSession, filter_of(hits, "locator")
    own = passing(docs.select(place(docs).alias("locator"), _text().alias("text")), "locator", found)
    block, parts = [], []

    def read() -> None:
        old = spark.read.schema("text string").parquet(*block)
        near = hits.where("earlier").select("locator").distinct()
        parts.append(written(passing(old.select(place(old).alias("locator"), _text().alias("text")), "locator", found).join(near, "locator", "left_semi"), "earlier"))
        block.clear()

    for row in hits.where("earlier").select("locator.file").distinct().toLocalIterator():  # FILES names at a time
        block.append(row["file"])
        if len(block) == FILES:
            read()
    if block:
        read()
    for part in parts:
        own = own.unionByName(part)
    return own.dropDuplicates(["locator"]) if parts else own


def exact_dedup(docs: DataFrame, digest=content_digest, state: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, locator.

    Texts are equal when their bytes are; a null text counts as an empty one. Of equal texts the row with the largest
    doc_id stays. Of repeated rows (same doc_id and text) exactly one stays. A null doc_id is smaller than any other;
    where all ids of a group are null, one row stays and keep_id is null. An empty table gives an empty result. Other
    columns are not looked at.

    digest: the hash of the text; one that collides still gives right results, as hits are compared in full.

    state: a folder that all executors reach, kept from call to call. Each call is then a new batch: groups hold the rows
    of all earlier batches too, and a row that they hold a larger doc_id for is not kept. The files of earlier batches
    must still be there. Without it, a new state is begun.
    """
    spark, docs = docs.sparkSession, located(docs)
    home = (state or scratch(spark, "exact")).rstrip("/")
    batch = uuid.uuid4().hex
    arrivals(docs, digest, batch).write.parquet(f"{home}/arrivals/{batch}")
    absorb(spark, f"{home}/arrivals/*", ARRIVALS, f"{home}/seen")
    known = seen(spark, f"{home}/seen")
    rows = spark.read.schema(ARRIVALS).parquet(f"{home}/arrivals/{batch}")
    everything = spark.read.schema(ARRIVALS).parquet(f"{home}/arrivals/*").withColumn("earlier", F.col("batch") != batch)
    own = known
    if state:  # of earlier batches, only what meets this one
        own = known.join(rows.select("digest").distinct(), "digest", "left_semi")
    hits = written(everything.join(own.where("n_rows > 1").select("digest"), "digest").select("digest", "doc_id", "locator", "earlier"), "hits")
    full = hits.join(_contents(docs, hits), "locator")
    # one group per digest by now, unless the digest collides
    groups = full.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n")).select("digest").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    clashing = written(groups.where("n > 1").select("digest"), "clashing")
    joined = rows.join(known, "digest", "left")
    winner, size = F.col("winner"), F.col("n_rows")
    if not clashing.isEmpty():
        apart = full.join(clashing, "digest", "left_semi").groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "locator")).alias("own_winner"), F.count(F.lit(1)).alias("own_size"))
        joined = joined.join(apart.select("digest", F.sha2("text", 256).alias("text_sha256"), "own_winner", "own_size"), ["digest", "text_sha256"], "left")
        winner, size = F.coalesce("own_winner", "winner"), F.coalesce("own_size", "n_rows")
    kept = F.col("locator") == winner["locator"]
    return joined.select("doc_id", winner["doc_id"].alias("keep_id"), size.alias("group_size"), kept.alias("kept"), "text_sha256", "locator")


def without_copies(docs: DataFrame, digest=content_digest, state: str | None = None) -> DataFrame:
    """docs without the rows that exact_dedup drops, all columns kept. Of repeated rows one stays."""
    rows, key = located(docs), new_name("place")
    gone = written(exact_dedup(rows, digest, state).where("NOT kept").select(F.col("locator").alias(key)), "copies")
    return without(rows.withColumn(key, place(rows)), key, gone).select(*docs.columns)

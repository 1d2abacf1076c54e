"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint has eight byte positions. Two fingerprints at a Hamming distance of 3 or less differ in at most three
bytes, so they share at least five positional bytes. Single positional bytes would make posting lists of N/256 rows, so
the index is keyed by four positional bytes at once: the 14 sets of four positions whose numbers xor to zero contain,
by the properties of that block design, a subset of every five positions, so each pair that shares five bytes meets
under one key at least. A posting list's fingerprints share four bytes; the tally goes on within the list, by the bytes
at the four other positions, and only fingerprints that reach five are compared bit by bit. Of a list of unlike
fingerprints that is one pair in 64.

Fingerprints enter the index once, however many documents have them. A posting list yields a spanning forest of its
links rather than every pair. A list longer than CHUNK is dealt anew by a fifth positional byte; what is still longer is
dealt out as pairs of chunks to several tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts
from rowloom.llm.components import connected_components
from rowloom.llm.rows import located, new_name, row_key, without
from rowloom.llm.tables import written

#: Sets of four of the eight byte positions; any five positions contain one of them.
BLOCKS = [b for b in itertools.combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]
#: Fingerprints of one posting list compared within a task: twice this number at most.
CHUNK = 4096
#: Keys of five positional bytes begin here: block, four bytes, position and byte of the fifth lie below.
FIFTH = 1 << 60
#: Cells of the comparison matrix held at once.
CELLS = 1 << 20


def shingles(text: str, words: int = 3, seed: int = 42) -> np.ndarray:
    """The hashes of the shingles of a text, in its order.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer words than a shingle has: the whole
    sequence is the one shingle. No word: none."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    width = min(words, len(tokens))
    ends = list(itertools.accumulate(map(len, tokens), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :])), np.uint64, len(tokens) - width + 1)


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of the shingles of a text, as a signed integer; zero if there is none."""
    return majority(shingles(text, words, seed))


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) and the carried binary columns for each row; a null text counts as
    empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fps = [fingerprint(text) for text in texts(batch.column("text"))]
            rest = [batch.column(name) for name in carried]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64()), *rest], ["doc_id", "fp", *carried])

    schema = ", ".join(["doc_id long", "fp long", *(f"{name} binary" for name in carried)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried).mapInArrow(run, schema)


def postings(nodes: DataFrame) -> DataFrame:
    """key, fp: one row for each block of each fingerprint. The key holds the block's number above its four bytes."""

    def key(number: int, block: tuple[int, ...]):
        packed = F.lit(number).cast("long")
        for position in block:
            packed = F.shiftleft(packed, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255)))
        return packed

    return nodes.select("fp", F.explode(F.array(*[key(i, b) for i, b in enumerate(BLOCKS)])).alias("key"))


def dealt(index: DataFrame) -> DataFrame:
    """Posting lists with two fingerprints or more, as (key, part, fp). A list of up to CHUNK is one part. A longer one
    is dealt by a fifth positional byte, under keys from FIFTH on; of lists that are longer than CHUNK even so, each pair
    of chunks is a part, so that any two of its fingerprints meet in some part."""
    sizes = written(_sizes(index), "list-sizes")
    short = index.join(sizes.where(F.col("n") <= CHUNK), "key").select("key", F.lit(0).cast("long").alias("part"), "fp")
    hot = sizes.where(F.col("n") > CHUNK)
    if hot.isEmpty():
        return short
    number = F.shiftright("key", 32).cast("int")
    others = F.get(F.array(*[F.array(*map(F.lit, _others(i))) for i in range(len(BLOCKS))]), number)
    byte = lambda position: F.call_function("shiftrightunsigned", F.col("fp"), 8 * position).bitwiseAND(F.lit(255))
    fifth = lambda position: F.lit(FIFTH) + F.shiftleft(F.col("key"), 11) + F.shiftleft(position.cast("long"), 8) + byte(position)
    anew = index.join(hot.select("key"), "key").select("fp", F.explode(F.transform(others, fifth)).alias("key"))
    return short.unionByName(chunked(anew.join(_sizes(anew), "key"), "fp", CHUNK).select("key", "part", "fp"))


def _sizes(index: DataFrame) -> DataFrame:
    return index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _others(block: int) -> list[int]:
    """The positions that are not in a block."""
    return [position for position in range(8) if position not in BLOCKS[block]]


def chunked(rows: DataFrame, node: str, size: int, most_bytes: int | None = None) -> DataFrame:
    """rows (lists by key, each with its length n) with the part: any two of a list meet in some part. Chunks have about
    `size` rows or, where rows carry the list's bytes too, `most_bytes`, whichever comes first."""
    chunks = F.ceil(F.col("n") / F.lit(size))
    if most_bytes:
        chunks = F.greatest(chunks, F.least(F.ceil(F.col("bytes") / F.lit(most_bytes)), F.col("n")))
    rows = rows.withColumn("chunks", chunks.cast("int"))
    own = F.pmod(F.xxhash64(node), F.col("chunks").cast("long")).cast("int")
    others = F.transform(
        F.expr("sequence(0, chunks - 1)"),
        lambda other: F.least(own, other).cast("long") * F.col("chunks") + F.greatest(own, other),
    )
    # with more than one chunk, a chunk meets itself in each part with another one
    parts = F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.array_remove(others, own.cast("long") * F.col("chunks") + own))
    return rows.select("*", F.explode(parts).alias("part"))


def near(fps: np.ndarray, others: np.ndarray, distance: int) -> np.ndarray:
    """Which of fps (rows) and others (columns) are in reach."""
    return np.bitwise_count((fps[:, None] ^ others[None, :]).view(np.uint64)) <= distance  # of signed numbers, numpy would count the magnitude's bits


def reaching(fps: np.ndarray, key: int) -> Iterator[np.ndarray]:
    """The sets of a posting list's fingerprints that share five positional bytes: the key's four and any other one.
    Under a key of five bytes, that is the list itself."""
    if key >= FIFTH:
        yield fps
        return
    for position in _others(key >> 32):
        byte = fps >> 8 * position & 255
        order = np.argsort(byte, kind="stable")
        bounds = np.flatnonzero(np.diff(byte[order])) + 1
        for start, end in itertools.pairwise([0, *bounds.tolist(), len(fps)]):
            if end - start > 1:
                yield fps[order[start:end]]


def forest(fps: np.ndarray, distance: int = 3) -> list[tuple[int, int]]:
    """Edges that span the link components among distinct fingerprints, each a star around its first one."""
    edges, left = [], np.arange(len(fps))
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            step = max(1, CELLS // len(left))
            for start in range(0, len(front), step):
                reached |= near(fps[front[start : start + step]], fps[left], distance).any(axis=0)
            front, left = left[reached], left[~reached]
            edges += [(int(fps[x]), int(fps[root])) for x in front]
    return edges


def spanning_links(parts: DataFrame, distance: int = 3) -> DataFrame:
    """a, b: links (distance at most 3) that connect what the posting lists connect."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """Key and fingerprints of one (key, part) after another; the rows are sorted by both."""
        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            fps = batch.column(2).to_numpy()
            bounds = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in itertools.pairwise([0, *bounds.tolist(), len(fps)]):
                if end == start:
                    continue
                if key != (this := tuple(keys[start])):
                    if held:
                        yield int(key[0]), np.concatenate(held)
                    key, held = this, []
                held.append(fps[start:end])
        if held:
            yield int(key[0]), np.concatenate(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []

        def out():
            table = np.array(edges, np.int64).reshape(-1, 2)
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(table.min(axis=1)), pa.array(table.max(axis=1))], ["a", "b"])

        for key, fps in runs(batches):
            for some in reaching(fps, key):
                edges += forest(some, distance)
            if len(edges) >= 10_000:
                yield out()
        if edges:
            yield out()

    rows = parts.select("key", "part", "fp").repartition("key", "part").sortWithinPartitions("key", "part")
    return rows.mapInArrow(run, "a long, b long").distinct()


def grouped(fps: DataFrame, distance: int = 3) -> DataFrame:
    """The written fingerprint rows with root (a fingerprint that names the component) and component_id."""
    if distance > 3:
        raise ValueError("the index guarantees links up to distance 3")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = spanning_links(dealt(postings(nodes.select("fp"))), distance)
    roots = connected_components(links).withColumnsRenamed({"node": "fp", "root": "own_root"})
    of = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("own_root", "fp"))
    first = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(of.join(first, "root").select("fp", "root", "component_id"), "fp")


def simhash_groups(docs: DataFrame, distance: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at `distance` (at most 3) or fewer differing bits are linked; component_id is the smallest doc_id that
    links reach, the row's own included. A null or wordless text has fingerprint zero, which links like any other.
    Null doc_ids take part in linking but are nobody's component_id, which is null where a component has no other.
    Repeated rows stay repeated. An empty table gives an empty result; other columns are not looked at."""
    rows = grouped(written(fingerprints(docs), "fingerprints"), distance)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of(keyed: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """keyed with the first row of each root: that with the smallest doc_id, those without one last. rows: doc_id, key,
    root for each row. Only ids are grouped; of the texts, those that may have to go are moved."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key)
    rows = written(rows, "roots")
    stay = rows.groupBy("root").agg(F.min(order).alias("first")).select(F.col(f"first.{key}").alias(key))
    return without(keyed, key, written(rows.select(key).join(stay, key, "left_anti"), "gone"))


def one_of_each(docs: DataFrame, distance: int = 3) -> DataFrame:
    """docs with one row of each group of near-duplicates, all columns kept: the row with the smallest doc_id (rows
    without one come last), of repeated doc_ids any one."""
    docs, key = located(docs), new_name("row")
    keyed = docs.withColumn(key, row_key(docs))
    rows = grouped(written(fingerprints(keyed, key), "fingerprints"), distance)
    return first_of(keyed, rows.select("doc_id", key, "root"), key).select(*docs.columns)

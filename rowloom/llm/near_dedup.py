"""Near copies by word shingles: operator 8's index and count filter over fingerprints of positional bytes.

Two texts are near copies if the Jaccard coefficient of their sets of five-word shingles is 0.8 or more. The first eight
positional bytes are operator 8's: the SimHash fingerprint of these shingles, indexed by its 14 blocks, so all texts whose
fingerprints are 3 bits apart or less meet. But at a similarity of 0.8, 15 % of SimHash's bits differ and a byte of
eight survives with a probability of 0.27 only, so no index over its bytes can guarantee such pairs. For those beyond its
reach 200 more positional bytes come from min-hashes: each is the same for both texts with a probability of their
similarity. All are in one inverted index keyed by several positional bytes at once (here 40 sets of five). What follows is
as in `simhash`: a tally of the positional bytes of min-hashes that two texts share (at 0.8, fewer than 120
of 200 have a probability below 1e-10), and an exact check of what reaches it. A pair at exactly 0.8 misses all 40 keys
with a probability of 1.2e-7, a closer one with less.

Texts of equal shingle sets are one node, however many there are. The lists of the index are used twice. First each
member is compared with the first one of its list, which costs as much as the list is long and settles groups of copies.
Only lists that still join members of different groups are then compared within, pair by pair, in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm import simhash
from rowloom.llm.batches import sliced, texts
from rowloom.llm.components import connected_components
from rowloom.llm.rows import filter_of, located, new_name, passing, row_key, without
from rowloom.llm.tables import written

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 40
#: Positional bytes of the SimHash fingerprint; they come before those of the min-hashes.
PRINT = 8
#: Positional bytes that a pair must share: a smaller share of them, and the pair is not looked at.
AGREE = 0.6
#: Shingles hashed at once.
STEP = 1024
#: Members of a list compared within a task: about twice this number at most, and twice so many bytes of shingles.
CHUNK, CHUNK_BYTES = 512, 16 << 20

_RNG = np.random.default_rng(42)
_A = _RNG.integers(0, 1 << 31, (ROWS * BANDS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32)
#: Odd; brings all bits of a min-hash into its upper byte.
_MIX = np.uint32(0x9E3779B1)


def shingle_set(text: str) -> np.ndarray:
    """The hashes of the shingles of a text, sorted, each once. Fewer words than a shingle has: one shingle of them all."""
    return np.unique(simhash.shingles(text, WORDS))


def positional_bytes(shingles: np.ndarray) -> np.ndarray:
    """A byte of the least of each of the 200 permutations of a set that isn't empty."""
    low = shingles.astype(np.uint32)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(low), STEP):
        np.minimum(least, (low[start : start + STEP] * _A + _B).min(axis=1), out=least)
    return (least * _MIX >> np.uint32(24)).astype(np.uint8)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard coefficient of at least SIMILARITY; sets of too unlike sizes need no comparison."""
    return min(len(a), len(b)) >= SIMILARITY * max(len(a), len(b)) and jaccard(a, b) >= SIMILARITY


def sketched(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, key, node, sketch (the positional bytes: of the fingerprint, then of the min-hashes; none for a text without
    words) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingle_set(text) for text in texts(batch.column("text"))]
            nodes = [xxhash.xxh64_intdigest(found.tobytes(), 7) - (1 << 63) for found in sets]
            sketches = [np.int64(simhash.majority(found)).tobytes() + positional_bytes(found).tobytes() if len(found) else b"" for found in sets]
            columns = [batch.column("doc_id"), batch.column(key), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", key, "node", "sketch"])

    schema = f"doc_id long, {key} binary, node long, sketch binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key).mapInArrow(run, schema)


def postings(nodes: DataFrame) -> DataFrame:
    """key, node: one row for each set of five positions and each block of the fingerprint. The key holds the number of the set
    above its five bytes; the blocks, of four bytes, have the numbers from BANDS on."""
    powers = (np.int64(256) ** np.arange(ROWS, dtype=np.int64))[None, None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, PRINT + ROWS * BANDS).astype(np.int64)
            keys = (raw[:, PRINT:].reshape(-1, BANDS, ROWS) * powers).sum(axis=2) + (np.arange(BANDS, dtype=np.int64) << 40)
            blocks = (raw[:, simhash.BLOCKS] * powers[0, :, :4]).sum(axis=2) + (np.arange(BANDS, BANDS + len(simhash.BLOCKS), dtype=np.int64) << 40)
            keys = np.concatenate([keys, blocks], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), keys.shape[1]))], ["key", "node"])

    return nodes.where(F.octet_length("sketch") > 0).select("node", "sketch").mapInArrow(run, "key long, node long")


def shingled(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """node, sketch, shingles of the rows wanted (node, key, sketch). Texts that the filter of the keys leaves out are
    not shuffled; what it lets through too much, the join leaves out."""
    rows = passing(docs.select(key, "text"), key, filter_of(wanted, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingle_set(text).astype("<u8").tobytes() for text in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(sets, pa.binary())], [key, "shingles"])

    found = rows.mapInArrow(run, f"{key} binary, shingles binary")
    return found.join(wanted, key).select("node", "sketch", "shingles")


def tallied(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that share enough positional bytes, tallied per pair."""
    of = lambda name: nodes.select(F.col("node").alias(name), F.col("sketch").alias(f"of_{name}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2048):
            a, b = (_sketches(batch, c) for c in ("of_a", "of_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= AGREE))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets (node, shingles) are alike."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            read = [[np.frombuffer(x, "<u8") for x in batch.column(c).to_pylist()] for c in ("of_a", "of_b")]
            yield batch.select(["a", "b"]).filter(pa.array([alike(a, b) for a, b in zip(*read)], pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def pair_off(nodes: np.ndarray, roots: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between members of different groups that connect all that are linked."""
    group = {r: r for r in roots.tolist()}

    def find(r: int) -> int:
        while group[r] != r:
            group[r] = r = group[group[r]]
        return r

    links = []
    for i in range(len(nodes) - 1):
        agree = (sketches[i + 1 :] == sketches[i]).mean(axis=1) >= AGREE
        for j in (np.flatnonzero(agree & (roots[i + 1 :] != roots[i])) + i + 1).tolist():
            x, y = find(int(roots[i])), find(int(roots[j]))
            if x != y and alike(sets[i], sets[j]):
                group[x] = y
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def suspects(parts: DataFrame) -> DataFrame:
    """Of the rows key, part, node, root, sketch those that share enough positional bytes with a member of another group
    in their part. The tally needs the sketches only, so the shingle sets of all others are never moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            sketches, roots = _sketches(rows), rows.column("root").to_numpy()
            met = np.zeros(len(roots), bool)
            for i in range(len(roots) - 1):
                found = ((sketches[i + 1 :] == sketches[i]).mean(axis=1) >= AGREE) & (roots[i + 1 :] != roots[i])
                met[i + 1 :] |= found
                met[i] |= found.any()
            yield from rows.filter(pa.array(met)).to_batches()

    schema = "key long, part long, node long, root long, sketch binary"
    return _by_part(parts.select("key", "part", "node", "root", "sketch")).mapInArrow(run, schema)


def paired_off(parts: DataFrame) -> DataFrame:
    """a, b: verified links within each (key, part) of the rows key, part, node, root, sketch, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for rows in _grouped(batches):
            sets = [np.frombuffer(x, "<u8") for x in rows.column("shingles").to_pylist()]
            links += pair_off(rows.column("node").to_numpy(), rows.column("root").to_numpy(), _sketches(rows), sets)
        table = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], ["a", "b"])

    return _by_part(parts).mapInArrow(run, "a long, b long").distinct()


def _sketches(rows: pa.Table | pa.RecordBatch, column: str = "sketch") -> np.ndarray:
    """The positional bytes that are tallied: those of the min-hashes."""
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint8).reshape(-1, PRINT + ROWS * BANDS)[:, PRINT:]


def _by_part(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "part").sortWithinPartitions("key", "part")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (key, part) after another, of rows sorted by both."""
    last, held = None, []
    for batch in batches:
        keys = np.stack([batch.column("key").to_numpy(), batch.column("part").to_numpy()], axis=1)
        bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(bounds, bounds[1:]):
            if end == start:
                continue
            if last != (this := tuple(keys[start])):
                if held:
                    yield pa.Table.from_batches(held)
                last, held = this, []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def grouped(nodes: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """node, root for every node that has near copies. nodes: node, key, sketch, a node once; docs: key, text."""
    index = postings(nodes)
    lists = index.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("key", "first")
    met = written(index.join(lists, "key").select("key", "node", "first"), "met")
    wanted = written(nodes.select("node", key, "sketch").join(met.select("node").distinct(), "node", "left_semi"), "wanted")
    sets = written(shingled(docs, key, wanted), "shingles")
    stars = met.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    near = written(verified(tallied(stars, wanted), sets), "near")
    roots = connected_components(near)
    sizes = sets.select("node", F.octet_length("shingles").cast("long").alias("bytes"))
    rows = met.join(sizes, "node").join(roots, "node", "left").select("key", "node", "bytes", F.coalesce("root", "node").alias("root"))
    mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).where("low < high")
    parts = simhash.chunked(rows.drop("bytes").join(mixed.select("key", "n", "bytes"), "key"), "node", CHUNK, CHUNK_BYTES).select("key", "part", "node", "root")
    parts = suspects(parts.join(wanted.select("node", "sketch"), "node"))
    more = written(paired_off(parts.join(sets.select("node", "shingles"), "node")), "paired")
    return roots if more.isEmpty() else connected_components(near.union(more))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each group that links of near copies connect, all columns kept: the row with the smallest
    doc_id (rows without one come last), of repeated doc_ids any one. Texts without words are copies of each other. A
    null text counts as empty; an empty table gives an empty result."""
    docs, key = located(docs), new_name("row")
    keyed = docs.withColumn(key, row_key(docs))
    rows = written(sketched(keyed, key), "sketches")
    nodes = written(rows.drop("doc_id").dropDuplicates(["node"]), "nodes")
    of = rows.select("doc_id", key, "node").join(grouped(nodes, keyed, key), "node", "left")
    return simhash.first_of(keyed, of.select("doc_id", key, F.coalesce("root", "node").alias("root")), key).select(*docs.columns)

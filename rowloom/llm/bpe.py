"""Byte-level BPE encoding and decoding with recursive queries.

Each worker keeps a DuckDB connection with the merge table of a rank file: (left, right, merged) for every two tokens
whose bytes together are a token. Pre-tokens that the worker has not met become token-position rows, one per byte; a
recursive query joins neighbours with the merge table and contracts in each round each word's leftmost pair of smallest
rank, until no word has a pair left.

Two neighbouring bytes that stand in no token of the vocabulary are never merged, nor is anything across them. Pre-tokens
are cut there, so a long blob without blanks is many short words. Where a piece is still longer than LONG bytes (runs of
one character, mostly), a round contracts all of its pairs of smallest rank, from the left and without overlap. For the
vocabulary of a trained tokenizer, in which every token encodes to itself, that is the same: while a pair (a, b) of rank r
is the smallest, no token of a smaller rank than r is made of a, b and their neighbours, as it would have been merged
before. Decoding joins (document, position, id) rows with the vocabulary and aggregates
the bytes in order.
"""

from __future__ import annotations

import base64
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts
from rowloom.llm.wordbpe import BYTE_LEVEL, PLAIN, Cache

#: White space as the rank files' pattern means it: the Unicode property White_Space.
WHITE = r"\t-\r \x85\xa0  -     　"
#: Pre-tokens that each of the two generations of a worker's cache holds at most.
CACHED = 300_000
#: Words and bytes of one recursive query (a longer word is one by itself), rows that its rounds may make, ids of one
#: decoding, bytes from which all pairs of smallest rank are contracted at once.
WORDS, SYMBOLS, ROWS, IDS, LONG = 10_000, 200_000, 4_000_000, 100_000, 64

#: One call advances each word by so many merges at most and returns its last rows. A word's best pair is the smallest
#: number made of its rank, its place and the place that the contraction empties (23 bits each for the places, of which
#: words of LONG bytes need seven).
MERGE = """
WITH RECURSIVE state AS (
  SELECT word, pos, id, 0 AS round FROM symbols
  UNION ALL
  SELECT s.word, s.pos, CASE WHEN s.pos = (pair >> 23) & 8388607 THEN (pair >> 46)::INT ELSE s.id END, s.round + 1
  FROM state s JOIN (
    SELECT p.word, min((m.merged::BIGINT << 46) | (p.pos::BIGINT << 23) | p.next_pos) AS pair
    FROM (SELECT word, pos, id, lead(id) OVER w AS next_id, lead(pos) OVER w AS next_pos
          FROM state WHERE round < {rounds} WINDOW w AS (PARTITION BY word ORDER BY pos)) p
    JOIN merges m ON m.l = p.id AND m.r = p.next_id
    GROUP BY p.word
  ) best ON s.word = best.word
  WHERE s.pos <> pair & 8388607
), last AS (SELECT word, max(round) AS round FROM state GROUP BY word)
SELECT word, pos, id, round FROM state JOIN last USING (word, round)
"""

#: The same for long words: all pairs of smallest rank, every second one where they overlap.
MERGE_LONG = """
WITH RECURSIVE state AS (
  SELECT word, pos, id, 0 AS round FROM symbols
  UNION ALL
  SELECT word, pos, CASE WHEN hit THEN merged ELSE id END, round + 1
  FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS emptied
    FROM (
      SELECT *, best AND row_number() OVER (PARTITION BY word, best, run ORDER BY pos) % 2 = 1 AS hit
      FROM (
        SELECT *, number - sum(best::INT) OVER (PARTITION BY word ORDER BY pos) AS run
        FROM (
          SELECT *, coalesce(merged = min(merged) OVER (PARTITION BY word), false) AS best, count(merged) OVER (PARTITION BY word) AS pairs
          FROM (SELECT word, pos, id, round, lead(id) OVER w AS next_id, row_number() OVER w AS number
                FROM state WHERE round < {rounds} WINDOW w AS (PARTITION BY word ORDER BY pos)) p
          LEFT JOIN merges m ON m.l = p.id AND m.r = p.next_id
        ) WHERE pairs > 0
      )
    )
  ) WHERE NOT emptied
), last AS (SELECT word, max(round) AS round FROM state GROUP BY word)
SELECT word, pos, id, round FROM state JOIN last USING (word, round)
"""

#: Bytes stand as characters of the same number, so that the ordered aggregate is text.
DECODE = """
SELECT doc, string_agg(chars, '' ORDER BY pos) AS chars FROM encoded JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Engine:
    """The merge table and vocabulary of a rank file in a connection of its own, and a cache of encoded words."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        spaces = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.general = regex.compile(spaces).findall
        self.plain = BYTE_LEVEL.findall if pattern == GPT_PATTERN else None
        self.single = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.meets = np.zeros((256, 256), bool)  # bytes that stand side by side in some token
        for token in ranks:
            raw = np.frombuffer(token, np.uint8)
            self.meets[raw[:-1], raw[1:]] = True
        self.cache = Cache(CACHED)
        # what does not fit in memory is spilled, as Spark's own sorts are, to the task's folder for temporary files
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        merges = np.array(pairs, np.int32).reshape(-1, 3)
        self._create("merges", {"l": merges[:, 0], "r": merges[:, 1], "merged": merges[:, 2]})
        self._create("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "chars": [token.decode("latin-1") for token in ranks]})

    def _create(self, name: str, columns: dict) -> None:
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def _ask(self, sql: str, name: str, columns: dict) -> pa.Table:
        self.con.register(name, pa.table(columns))
        found = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return found

    def split(self, text: str) -> list[str]:
        return self.plain(text) if self.plain and not PLAIN.search(text) else self.general(text)

    def pieces(self, raw: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The words, cut wherever no token spans two bytes, and how many pieces each word has."""
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(x) for x in raw])
        cut = np.zeros(len(flat) + 1, bool)
        cut[1:-1] = ~self.meets[flat[:-1], flat[1:]]
        cut[ends] = True
        bounds = np.flatnonzero(cut)
        joined = flat.tobytes()
        return [joined[a:b] for a, b in zip([0, *bounds.tolist()], bounds.tolist())], np.diff(np.searchsorted(bounds, ends, side="right"), prepend=0)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word, none of them empty, by recursive queries."""
        found, counts = self.pieces([word.encode("utf-8", "replace") for word in words])
        distinct = sorted(set(found), key=len)
        ids: dict[bytes, np.ndarray] = {}
        start = 0
        while start < len(distinct):
            end, size, is_long = start, 0, len(distinct[start]) > LONG
            while end < min(len(distinct), start + WORDS) and (end == start or size + len(distinct[end]) <= SYMBOLS) and (len(distinct[end]) > LONG) == is_long:
                size += len(distinct[end])
                end += 1
            part = distinct[start:end]
            ids.update(zip(part, self._contracted(part, MERGE_LONG if is_long else MERGE)))
            start = end
        at, out = np.cumsum(counts), []
        for a, b in zip([0, *at.tolist()], at.tolist()):
            out.append(ids[found[a]] if b - a == 1 else np.concatenate([ids[piece] for piece in found[a:b]]))
        return out

    def _contracted(self, raw: list[bytes], sql: str) -> list[np.ndarray]:
        sizes = np.array([len(x) for x in raw], np.int64)
        word = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        ids = self.single[np.frombuffer(b"".join(raw), np.uint8)]
        done: list[tuple[np.ndarray, ...]] = []
        while len(word):
            most = min(24, max(1, ROWS // len(word)))  # the recursion keeps the rows of all of its rounds
            rows = self._ask(sql.format(rounds=most), "symbols", {"word": word, "pos": pos, "id": ids})
            word, pos, ids, rounds = (rows.column(i).to_numpy() for i in range(4))
            ended = rounds < most
            done.append((word[ended], pos[ended], ids[ended]))
            word, pos, ids = word[~ended], pos[~ended], ids[~ended]
        word, pos, ids = (np.concatenate(part) for part in zip(*done))
        order = np.lexsort((pos, word))
        bounds = np.searchsorted(word[order], np.arange(len(raw) + 1))
        ids = ids[order]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin (one more entry at the end)."""
        split = [self.split(text) for text in batch]
        met = self.cache.known(set().union(*split))
        missing = [word for word, raw in met.items() if raw is None]
        if missing:
            for name, ids in zip(missing, self.encode_words(missing)):
                met[name] = ids.tobytes()
                self.cache.put(name, met[name])
        raw = [b"".join(map(met.__getitem__, words)) for words in split]
        return np.frombuffer(b"".join(raw), np.int32), np.cumsum([0, *(len(x) // 4 for x in raw)])

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """The bytes of each list of ids; an id that is not in the vocabulary adds none."""
        bounds, flat = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten()
        out, start = [b""] * len(ids), 0
        while start < len(ids):
            end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + IDS, side="right")) - 1)
            a, b = bounds[start], bounds[end]
            doc = np.repeat(np.arange(start, end, dtype=np.int32), np.diff(bounds[start : end + 1]))
            found = self._ask(DECODE, "encoded", {"doc": doc, "pos": np.arange(b - a, dtype=np.int32), "id": flat.slice(a, b - a)})
            for number, chars in zip(found.column("doc").to_pylist(), found.column("chars").to_pylist()):
                out[number] = chars.encode("latin-1")
            start = end
        return out


@lru_cache(maxsize=2)
def engine(path: str, pattern: str) -> Engine:
    """One engine for each rank file in a worker, kept from task to task."""
    return Engine(path, pattern)


#: The pattern that splits text before the merges (fixed value).
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encode(docs: DataFrame, ranks: str, pattern: str = GPT_PATTERN, decoded: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids (array of int), as the tiktoken library encodes the text without special
    tokens. A null or empty text has no ids. Null doc_ids and repeated rows are rows like others; an empty table gives
    an empty result. Columns other than doc_id and text are not looked at.

    decoded: the ids are decoded again by the same worker, as `decode` does, into a column of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(ranks, pattern)
        for batch in sliced(batches):
            flat, bounds = own.encode(texts(batch.column("text")))
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            back = [pa.array(own.decode(ids), pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, *back], ["doc_id", "ids", "decoded"][: 2 + decoded])

    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, pattern: str = GPT_PATTERN) -> DataFrame:
    """The rows of encode() with the bytes of their ids: doc_id, ids, decoded (binary). Null or no ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(ranks, pattern)
        for batch in sliced(batches):
            ids = batch.column("ids")
            flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(ids.value_lengths().fill_null(0).to_numpy())]), pa.int32()), ids.flatten())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(own.decode(flat), pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")

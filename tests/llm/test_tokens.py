"""Packing, token counts and BPE against the tokenizers' own libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowloom.llm import bpe, packing, token_counts, wordbpe

WORD, BYTE, RANKS = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
TEXTS = [
    "", " ", "Hello  World\n\n  it's 12345 ²½ !!! — “q” foo", "a <|endoftext|> b", "\x1cab\x85c d\x00", "İstanbul ǅ ŉ ǰ ß x­x", "日本語テキスト   　 x", "don't  STOP\t\r\n ",
    "á é", "  lead", "trail  ", "\n\n\nx", "😀😀 ok", "a" * 3000, " " * 700 + "x", "=-" * 900, "word " * 3000, None,
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, ids string, queue string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, "x", "y") for i, t, s in rows], DOCS)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder(path):
    made, library = wordbpe.Encoder(path), Tokenizer.from_file(path)
    texts = [t or "" for t in TEXTS]
    assert [x.tolist() for x in made.ids(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_on_all_latin_letters(path):
    """Every character up to U+024F beside letters, marks, digits and quotes: lower case of some lies beyond."""
    made, library = wordbpe.Encoder(path), Tokenizer.from_file(path)
    every = list(map(chr, range(0x250)))
    texts = [a + b for a in every for b in ("a", "Z", "1", "'s", " ", "\u0301", "é", "!", "’")] + [b + a for a in every for b in ("a", "Z", "1", "'", "é", " ")]
    rng = random.Random(1)
    texts += ["".join(rng.choice([*every, *"‐–’“•…€ \n  "]) for _ in range(rng.randrange(1, 30))) for _ in range(3_000)]
    texts += ["KƆKƆƆ", "WƆN", "NUNƆLA", "AKƐNDE", "HAƁAKA", "SOƊE", "(ƆSƐ)", "MƱA"]
    assert [x.tolist() for x in made.ids(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "x y", "s"), (1, "again", None), (1, "again", None)]
    library = Tokenizer.from_file(BYTE)
    wanted = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows), key=str)
    for most in (0, 5, 30_000):
        got = token_counts.token_counts(docs(spark, rows), BYTE, most=most).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == wanted
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_counts.token_counts(docs(spark, []), BYTE).count() == 0


def test_frequent_lengths_are_bounded(spark):
    """The table holds the most frequent words of the sample, none that is long; a doc_id that most rows have or that is
    null weighs by its rows."""
    rows = [(7, f"often seen w{i} " + "long" * 40, "s") for i in range(300)] + [(None, "null ids too", "s")] * 50
    library = Tokenizer.from_file(BYTE)
    found = token_counts.frequent_lengths(docs(spark, rows), BYTE, sample=1_000, most=4)
    assert len(found) == 4 and {"often", " seen", " w"} <= set(found) and all(found[w] == len(library.encode(w, add_special_tokens=False).ids) for w in found)
    whole = token_counts.frequent_lengths(docs(spark, rows), BYTE, sample=1_000)
    assert max(map(len, whole)) <= token_counts.LONGEST and "null" in whole
    few = token_counts.frequent_lengths(docs(spark, rows), BYTE, sample=20)
    assert few and len(few) < len(whole)
    assert token_counts.frequent_lengths(docs(spark, []), BYTE) == {} and token_counts.frequent_lengths(docs(spark, rows), BYTE, most=0) == {}


def test_long_and_foreign_texts(spark):
    """Scripts beyond the plain characters go through both tiers too, as do texts of megabytes."""
    rows = [(1, "Привет, мир! Это тест. " * 3000, "s"), (2, "日本語 テキスト" * 2000, "s"), (3, "word " * 400_000, "s"), (4, "q" * 1_000_000, "s"), (5, "a <|endoftext|> é😀 b", "s")]
    library = Tokenizer.from_file(BYTE)
    assert wordbpe.Encoder(BYTE).pre_tokens(rows[0][1])[:3] == ["Привет", ",", " мир"] and wordbpe.Encoder(BYTE).pre_tokens(rows[4][1]) is None
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs(spark, rows), BYTE).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t, _ in rows}


def test_cache_keeps_what_is_asked_for():
    cache = wordbpe.Cache(3)
    for n in range(20):
        cache.put(f"w{n}", n)
        assert cache.get("hot") in (None, 1)
        if n == 0:
            cache.put("hot", 1)
    assert cache.get("hot") == 1 and cache.get("w2") is None and len(cache.young) <= 3 and len(cache.old) <= 3


def test_bpe(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "x", "s")]
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert public_tokenizers.PATTERN == bpe.GPT_PATTERN
    encoded = bpe.encode(docs(spark, rows), RANKS)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(((i, own.encode_ordinary(t or "")) for i, t, _ in rows), key=str)
    for decoded in (bpe.decode(encoded, RANKS), bpe.encode(docs(spark, rows), RANKS, decoded=True)):
        assert sorted(((r.doc_id, bytes(r.decoded)) for r in decoded.collect()), key=str) == sorted(((i, (t or "").encode()) for i, t, _ in rows), key=str)
    nothing = spark.createDataFrame([(1, None), (2, []), (3, [70_000])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(nothing, RANKS).collect()] == [b"", b"", b""]


def test_bpe_of_long_pre_tokens():
    """Single pre-tokens of up to a million bytes: blobs, runs, two letters. Seconds each, where the library takes them."""
    rng = random.Random(9)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    engine = bpe.Engine(RANKS, bpe.GPT_PATTERN)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=100_000)), "".join(rng.choices(letters + letters.upper(), k=1_000_000)), "a" * 100_001, "=-" * 20_000, "ab" * 30_000 + "c"]
    words += ["".join(rng.choices("aelstn", k=n)) for n in (63, 64, 65, 66, 500, 3000)] + ["é" * 5000, "=" * 1_000_000, "日本" * 2000]
    for word in words:
        flat, bounds = engine.encode([word])
        assert bounds.tolist() == [0, len(flat)] and flat.tolist() == own.encode_ordinary(word)


def test_every_token_encodes_to_itself():
    """What contracting all pairs of smallest rank at once rests on."""
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    assert all(own.encode_single_token(token) == rank for token, rank in ranks.items())
    assert all(own._core_bpe.encode_single_piece(token) == [rank] for token, rank in ranks.items())


@pytest.mark.parametrize("trial", range(40))
def test_plan_fills_every_window(trial):
    rng = random.Random(trial)
    queues, size = rng.randint(1, 9), rng.choice([16, 32, 64])
    totals = [rng.choice([0, 1, 3, rng.randint(0, 4000)]) for _ in range(queues)]
    mixture = [rng.random() for _ in range(queues)] if trial % 2 else None
    phases, filled = packing.plan(totals, size, mixture), {}
    for queue, total in enumerate(totals):
        at = 0
        while at < total:
            length = min(rng.randint(1, 200), total - at)
            _, first, count, window, offset = packing.pieces(phases, np.array([queue]), np.array([at]), np.array([length]), size)
            assert sorted(x for a, c in zip(first, count) for x in range(a, a + c)) == list(range(length))
            for o, c, w in zip(offset, count, window):
                for k in range(o, o + c):
                    assert filled.setdefault((w, k), queue) == queue
            at += length
    assert set(filled) == {divmod(i, size) for i in range(sum(totals))}


def test_shares_hold_in_every_window():
    totals, size = [50_000, 30_000, 1_000, 700], 256
    (phase, *_) = packing.plan(totals, size)
    before = phase.before(np.arange(phase.windows + 1), size)
    wanted = np.outer(np.arange(phase.windows + 1), np.array(totals) * size / sum(totals))
    assert (np.diff(before, axis=0).sum(axis=1) == size).all() and np.abs(before - wanted).max() < 1.5


def test_pack(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "gamma-ray", "x1"]) for _ in range(rng.randrange(200))), rng.choice(["a", "a", "a", "b", None, f"s{i % 7}"])) for i in range(300)]
    rows += [(3, "again", "a"), (3, "again", "a"), (None, "no id", "b"), (400, None, "c"), (401, "", "c"), (402, "long " * 9000, "d")]
    library = Tokenizer.from_file(WORD)
    wanted = sorted(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, t, _ in rows)
    for mixture in (None, {"a": 3.0, "b": 1.0}):
        for queues in (3, 64):
            got = packing.pack(docs(spark, rows), WORD, size=128, mixture=mixture, queues=queues).toPandas()
            assert (got.length == got.ids.map(len) // 4).all()
            by_sequence = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
            fill = by_sequence.length.sum()
            assert (fill.values[:-1] == 128).all() and list(fill.index) == list(range(len(fill)))
            assert all((g.offset.values == np.cumsum(g.length.values) - g.length.values).all() for _, g in by_sequence)
            alone = got[~got.doc_id.isin([3]) & got.doc_id.notna()].sort_values(["doc_id", "start"]).groupby("doc_id")
            assert all((g.start.values == np.cumsum(g.length.values) - g.length.values).all() and g.length.sum() == g.doc_tokens.iloc[0] for _, g in alone)
            whole = sorted(b"".join(g.ids) for _, g in alone)
            assert set(whole) <= set(wanted) and got.length.sum() == sum(map(len, wanted)) // 4
    crc = packing.pack(docs(spark, rows[:5]), WORD).withColumn("crc", F.crc32("ids")).first()
    assert crc.crc == zlib.crc32(bytes(crc.ids))
    assert packing.pack(docs(spark, []), WORD).count() == 0


def simulated(totals, size, mixture):
    """Window after window and token after token: each node of the tree keeps what it has served and gives its next token
    to the child that is furthest behind."""
    left, done, windows = list(totals), [0] * len(totals), []
    depth = (len(totals) - 1).bit_length()
    counters = {}

    def weights():
        held = [m if n > 0 else 0.0 for m, n in zip(mixture, left)]
        return [round(m / sum(held) * packing.SCALE) if m else 0 for m in held] if sum(held) else list(left)

    def draw(own):
        node, low, high = 1, 0, 1 << depth
        while high - low > 1:
            middle = (low + high) // 2
            a, whole = sum(own[low:middle]), sum(own[low:high])
            served, first = counters.get(node, (0, 0))
            take = (2 * (served + 1) * a + whole) // (2 * whole) > first if whole % 2 == 0 else ((served + 1) * a + whole // 2) // whole > first
            counters[node] = (served + 1, first + take)
            node, low, high = (2 * node, low, middle) if take else (2 * node + 1, middle, high)
        return low

    own, natural = weights(), not any(mixture)
    while sum(left):
        window = [0] * len(totals)
        saved = dict(counters)
        for _ in range(min(size, sum(left))):
            window[draw(own)] += 1
        if any(w > n for w, n in zip(window, left)) or (not natural and sum(left) < size):
            return windows, saved  # the phase ends here
        if natural and sum(left) < size:
            return windows, saved
        windows.append(window)
        left = [n - w for n, w in zip(left, window)]
    return windows, counters


@pytest.mark.parametrize("trial", range(12))
def test_plan_is_the_simulated_round_robin(trial):
    rng = random.Random(trial)
    totals = [rng.randint(1, 3000) for _ in range(rng.randint(2, 11))]
    mixture = [rng.choice([0.01, 1.0, 7.5]) * rng.random() for _ in totals] if trial % 2 else None
    (phase, *_) = packing.plan(totals, 64, mixture)
    windows, _ = simulated(totals, 64, mixture or [0.0] * len(totals))
    n = min(len(windows), phase.windows)
    assert n == phase.windows or len(windows) < 2
    assert np.diff(phase.before(np.arange(n + 1), 64), axis=0).tolist() == windows[:n]


def test_many_sources_hold_their_proportions():
    rng = random.Random(1)
    totals = [int(10 ** rng.uniform(1, 6)) for _ in range(200)]
    (phase, *_) = packing.plan(totals, 512)
    before = phase.before(np.arange(0, phase.windows + 1, 7), 512)
    wanted = np.outer(np.arange(0, phase.windows + 1, 7), np.array(totals) * 512 / sum(totals))
    assert np.abs(before - wanted).max() <= 0.5 * phase.depth  # also for shares of far less than a token a window


def test_a_mixture_names_a_small_source(spark):
    rows = [(i, "word " * 30, f"s{i % 50}") for i in range(1000)] + [(2000 + i, "rare " * 40, "tiny") for i in range(3)]
    for queues in (2, 64):
        got = packing.pack(docs(spark, rows), WORD, size=64, mixture={"tiny": 1.0, "s1": 3.0}, queues=queues).toPandas()
        first = got[got.sequence_id < 7].groupby(["sequence_id", "source"]).length.sum().unstack(fill_value=0)
        assert (first["tiny"] == 16).all() and (first["s1"] == 48).all()


def test_a_small_cache_gives_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, small = wordbpe.Encoder(path), wordbpe.Encoder(path, 5)
    batch = [" ".join(f"word{i * k % 37} other" for i in range(50)) for k in range(4)]
    assert [x.tolist() for x in own.ids(batch)] == [x.tolist() for x in small.ids(batch)]
    assert len(small.cache.young) <= 5 < len(own.cache.young)

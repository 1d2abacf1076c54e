"""Exact, near and line deduplication against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rowloom.llm import components, exact_dedup, line_dedup, near_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, fp long, digest string"


def docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 7, "x") for i, t in rows], DOCS)


CASES = [(1, "a"), (5, "a"), (3, "a "), (9, None), (10, ""), (4, "b"), (4, "b"), (None, "c"), (None, "c"), (8, "x" * 200_000), (2, "x" * 200_000), (6, "x" * 199_999 + "y")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, weak):
    digest = (lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))) if weak else exact_dedup.content_digest
    got = exact_dedup.exact_dedup(docs(spark, CASES), digest).collect()
    assert len(got) == len(CASES)
    groups = {}
    for i, t in CASES:
        groups.setdefault(t or "", []).append(i)
    for r in got:
        text = next(t or "" for i, t in CASES if hashlib.sha256((t or "").encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == max(ids, default=None) and r.group_size == len(groups[text])
        assert not r.kept or r.doc_id == r.keep_id
    if not weak:
        assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.without_copies(docs(spark, CASES), digest)
    assert left.columns == docs(spark, []).columns
    assert sorted((r.text or "" for r in left.collect())) == sorted(groups)


def test_exact_keeps_state_between_runs(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    for part in ([(1, "a"), (2, "b")], [(3, "a")], [(0, "b"), (9, "c")]):
        rows = exact_dedup.arrivals(docs(spark, part))
        rows.write.mode("append").parquet(source)
        exact_dedup.absorb(spark, source, rows.schema, checkpoint, files_per_batch=1)
    state = {r.winner.doc_id: r.n_rows for r in exact_dedup.seen(spark, checkpoint).collect()}
    assert state == {3: 2, 2: 2, 9: 1}


def test_exact_of_a_second_batch(spark, tmp_path):
    """Groups hold what earlier batches brought; full texts are compared across batches, also under a weak digest."""
    weak = lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))
    rng = random.Random(5)
    for number, digest in enumerate((exact_dedup.content_digest, weak)):
        parts = [[(rng.randrange(1000), rng.choice("abcdefgh") * rng.randrange(4)) for _ in range(40)] for _ in range(3)]
        parts[1] += [(None, "aa"), (5000, "only here")]
        came = []
        for k, part in enumerate(parts):
            path = str(tmp_path / f"{number}-{k}")
            docs(spark, part).repartition(3).write.parquet(path)
            got = exact_dedup.exact_dedup(spark.read.parquet(path), digest, str(tmp_path / f"state-{number}")).collect()
            came += part
            groups = {}
            for i, t in came:
                groups.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(i)
            assert len(got) == len(part)
            for r in got:
                ids = groups[r.text_sha256]
                assert (r.keep_id, r.group_size) == (max((i for i in ids if i is not None), default=None), len(ids))
                assert not r.kept or r.doc_id == r.keep_id
            alone = {sha for sha, ids in groups.items() if len(ids) == 1}
            assert all(r.kept for r in got if r.text_sha256 in alone)


def test_places_are_stable(spark, tmp_path):
    docs(spark, CASES).repartition(3).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    first, again = ({r.locator: r.text_sha256 for r in exact_dedup.arrivals(read).collect()} for _ in range(2))
    assert first == again and len(first) == len(CASES)
    lines = read.select("doc_id", F.explode(F.array("text", F.lit("b"))).alias("text"))  # several rows of one place
    left = exact_dedup.without_copies(lines)
    assert sorted(r.text or "" for r in left.collect()) == sorted({t or "" for _, t in CASES} | {"b"})


def test_exact_is_native(spark):
    plan = exact_dedup.exact_dedup(docs(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    label = {i: i for i in range(len(fps))}
    find = lambda i: i if label[i] == i else find(label[i])
    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 3 and find(a) != find(b):
            label[find(a)] = find(b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: min(groups[find(k)]) for k, i in enumerate(ids)}


def near_texts():
    rng, words = random.Random(2), [f"w{i}" for i in range(300)]
    rows = []
    for n in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 40, 200]))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            if len(copy) > 10 and rng.random() < 0.8:
                copy[rng.randrange(len(copy))] = "Changed"
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows + [(900, ""), (901, " \t\n"), (902, "Einzel wort"), (903, "ÄB c"), (904, "äb c")]


def test_simhash(spark):
    rows = near_texts()
    got = {r.doc_id: r for r in simhash.simhash_groups(docs(spark, rows)).collect()}
    fps = [brute_fingerprint(t) for _, t in rows]
    assert [got[i].fingerprint for i, _ in rows] == [f"{fp:016x}" for fp in fps]
    assert {i: r.component_id for i, r in got.items()} == brute_components([i for i, _ in rows], fps)
    left = simhash.one_of_each(docs(spark, rows))
    assert sorted(r.doc_id for r in left.collect()) == sorted({r.component_id for r in got.values()})


def test_simhash_edges(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None), (None, "only here with no id at all")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 5), (5, 5), (5, 5), (7, 7), (None, None)], key=str)
    assert sorted((r.doc_id for r in simhash.one_of_each(docs(spark, rows)).collect()), key=str) == [5, 7, None]
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [8, 40, 4096])
def test_index_finds_every_link(spark, monkeypatch, chunk):
    """Chunks of long posting lists and few bits of difference, at every distance."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(50)} | {centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(6))}) for _ in range(120)}
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f) for f in fps]
    links = simhash.spanning_links(simhash.dealt(simhash.postings(spark.createDataFrame([(s,) for s in signed], "fp long"))))
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    wanted = brute_components(list(range(len(fps))), fps)
    named = {}
    for k, s in enumerate(signed):
        assert named.setdefault(roots.get(s, s), wanted[k]) == wanted[k]
    assert len(named) == len(set(wanted.values()))


def test_tally_spares_what_cannot_link():
    """Fingerprints under one key of four bytes: only those that share a fifth one are compared."""
    rng = np.random.default_rng(7)
    block = simhash.BLOCKS[3]
    fps = np.unique(rng.integers(-(2**62), 2**62, 600))
    for position in block:
        fps = fps & ~np.int64(255 << 8 * position) if position < 7 else fps & np.int64((1 << 56) - 1)
    fps = np.unique(fps)
    pairs = set()
    for some in simhash.reaching(fps, 3 << 32):
        pairs |= {tuple(sorted(pair)) for pair in itertools.combinations(some.tolist(), 2)}
    shared = lambda a, b: sum((a ^ b) >> 8 * p & 255 == 0 for p in range(8))
    assert pairs == {tuple(sorted(pair)) for pair in itertools.combinations(fps.tolist(), 2) if shared(*pair) >= 5}
    assert len(pairs) < len(fps) * (len(fps) - 1) / 2 / 30


def test_blocks_cover_five_bytes():
    assert len(simhash.BLOCKS) == 14
    assert all(any(set(b) <= set(five) for b in simhash.BLOCKS) for five in itertools.combinations(range(8), 5))


def planted_texts():
    """Groups of near copies down to a similarity of about 0.75, chains of them, and texts that share a passage."""
    rng, words = random.Random(6), [f"w{i}" for i in range(4000)]
    passage, rows = [rng.choice(words) for _ in range(60)], []
    for n in range(50):
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 150, 400]))] + (passage if n % 3 == 0 else [])
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((len(rows) * 3 + 1, " ".join(base)))
            if len(base) > 20:
                base = list(base)
                for _ in range(rng.randrange(1, 2 + len(base) // 40)):
                    base[rng.randrange(len(base))] = "Changed"
    return rows + [(900, ""), (901, " \t\n"), (902, "Einzel wort"), (903, "ÄB c"), (904, "äb c"), (905, "EINZEL  WORT")]


@pytest.mark.parametrize("chunk, size", [(2, 16 << 20), (512, 16 << 20), (512, 3000)])
def test_near_copies(spark, monkeypatch, chunk, size):
    """Whole groups against brute force; SimHash leaves most of the pairs."""
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", size)
    rows = planted_texts()
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split()
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := lower(t)) else set() for _, t in rows]
    label = list(range(len(rows)))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    wanted = {}
    for k, (i, _) in enumerate(rows):
        wanted[label[k]] = min(i, wanted.get(label[k], i))
    assert sorted(r.doc_id for r in near_dedup.one_of_each(docs(spark, rows)).collect()) == sorted(wanted.values())
    fps = [brute_fingerprint(t) for _, t in rows]
    assert sum(bin(fps[a] ^ fps[b]).count("1") <= 3 for a, b in pairs) < 0.5 * len(pairs)


def test_stage_links_by_fingerprints(spark, monkeypatch):
    """Operator 8's fingerprints and blocks alone, without the keys of min-hashes: the stage finds the near copies that share
    a block, those at 3 bits or fewer among them."""
    rng = random.Random(11)
    bases = [[rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(900)] for _ in range(12)]
    rows = [(2 * n + at, " ".join(base[: 900 - 9 * at])) for n, base in enumerate(bases) for at in (0, 1)]
    fps = [simhash.majority(near_dedup.shingle_set(t)) & (2**64 - 1) for _, t in rows]
    close = {n for n in range(12) if (fps[2 * n] ^ fps[2 * n + 1]).bit_count() <= 3}
    byte = lambda fp, at: fp >> 8 * at & 255
    met = {n for n in range(12) if any(all(byte(fps[2 * n], at) == byte(fps[2 * n + 1], at) for at in block) for block in simhash.BLOCKS)}
    assert close and close <= met
    every = near_dedup.postings
    monkeypatch.setattr(near_dedup, "postings", lambda nodes: every(nodes).where(F.col("key") >= near_dedup.BANDS << 40))
    left = {r.doc_id for r in near_dedup.one_of_each(docs(spark, rows)).collect()}
    assert left == {i for i, _ in rows} - {2 * n + 1 for n in met}


def test_stage_drops_near_copies(spark):
    """One word of a hundred changed: a similarity of 0.90, but SimHashes further apart than 3 bits."""
    import corpus_pipeline

    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:50] + ["Changed"] + base[51:])), (3, " ".join(base[::-1]))]
    assert bin(brute_fingerprint(rows[0][1]) ^ brute_fingerprint(rows[1][1])).count("1") > 3
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs(spark, rows), "").collect()) == [1, 3]


def test_near_copies_edges(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None), (None, "only here with no id at all"), (8, "A  b c D")]
    left = near_dedup.one_of_each(docs(spark, rows))
    assert left.columns == docs(spark, []).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [5, 7, None]
    assert near_dedup.one_of_each(docs(spark, [])).count() == 0


def test_long_texts(spark):
    """Texts of a million words and lines, copies and near copies of them."""
    words = [f"w{i}" for i in range(200_000)]
    long, near = " ".join(words), " ".join(words[:-1] + ["other"])
    rows = [(1, long), (2, near), (3, "x" * 2_000_000), (4, long), (5, "short text of six words here")]
    got = {r.doc_id: r for r in simhash.simhash_groups(docs(spark, rows)).collect()}
    assert got[1].fingerprint == got[4].fingerprint == f"{simhash.majority(simhash.shingles(long)) & (2**64 - 1):016x}" and got[4].component_id == 1
    assert sorted(r.doc_id for r in near_dedup.one_of_each(docs(spark, rows)).collect()) == [1, 3, 5]
    assert sorted(r.doc_id for r in exact_dedup.without_copies(docs(spark, rows)).collect()) == [2, 3, 4, 5]
    lines = [(i, "\n".join(f"a line that many documents share, number {k}" for k in range(100_000)) + f"\nown {i}") for i in range(6)]
    cut = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, lines)).collect()}
    assert [cut[i].n_dropped for i in range(6)] == [100_000] * 5 + [0] and cut[2].text == "own 2"


def test_components(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(40)]
    edges = path + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_is_exact():
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([rng.integers(-(2**62), 2**62, 40), np.int64(12345) ^ (1 << rng.integers(0, 62, 60)).astype(np.int64)]))
    edges = simhash.forest(fps, 3)
    label = brute_components(list(range(len(fps))), [int(f) & (2**64 - 1) for f in fps])
    assert len(edges) == len(fps) - len(set(label.values()))


def brute_lines(rows, least_chars, least_docs):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)] - {None}) < least_docs or i == max(holders[key(x)] - {None})]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng, pool = random.Random(8), [f"Line Number {i} ÄÖ" + "." * (i % 9) for i in range(12)]
    rows = [(i, "\n".join(rng.choice([" ", "", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) + rng.choice([" ", "\r", " "]) for _ in range(rng.randrange(9)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (None, "\n".join(pool)), (3, pool[0]), (3, pool[0])]
    got = [tuple(r) for r in line_dedup.line_dedup(docs(spark, rows), 15, 5).collect()]
    assert sorted(got, key=str) == brute_lines(rows, 15, 5)
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0

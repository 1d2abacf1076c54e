"""Byte tables, importance resampling, lexical search and language labels against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rowloom.llm import importance, langid, lexical, wordbytes

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, score long, rank string, row string, term string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "s", 7, "x", "y", "z") for i, t in rows], DOCS)


def some_texts(n, seed=3):
    rng = random.Random(seed)
    vocabulary = ["a", "Bc", "ÄÖ", "日本", "x" * 40, "don't", "it", "7", "thé", "Ab", "bc", *(f"w{i}" for i in range(40))]
    return ["", None, " \n ", *(rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 20, 60]))) for _ in range(n))]


def test_words_and_tables(monkeypatch):
    texts = [*some_texts(60), "A", "b", "z" * 300, "İx\x00y"]
    for size in (1 << 21, 50, 1):
        monkeypatch.setattr(wordbytes, "BYTES", size)
        for column in (pa.array(texts), pa.array(["skipped", *texts])[1:]):
            got = []
            for first, found in wordbytes.words_of(column):
                assert first == len(got)
                raw = found.buffer.tobytes()
                own = [raw[a : a + n].decode() for a, n in zip(found.begin.tolist(), found.size.tolist())]
                got += [own[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
            assert got == list(map(words, texts))
    strings = [bytes([97 + i % 7]) * i for i in range(1, 120)] * 2
    buffer, begin, size = wordbytes.of_list(strings)
    assert wordbytes.hashed(buffer, begin, size).tolist() == [xxhash.xxh64_intdigest(s) for s in strings]
    table = wordbytes.Table(buffer, begin, size)
    assert sorted(table.strings()) == sorted(set(strings))
    others = wordbytes.of_list([strings[5], b"nowhere", strings[70][:-1] + b"!"])
    assert [i >= 0 and strings[i] for i in table.find(*others)] == [strings[5], False, False]


def test_table_compares_bytes(monkeypatch):
    """Keys that all collide still give a slot for each string."""
    monkeypatch.setattr(wordbytes, "hashed", lambda buffer, begin, size: np.full(len(size), 5, np.uint64))
    strings = [b"abcdefghi", b"abcdefghj", b"abcdefghi", b"ab", b"abcdefgh", b"zbcdefghi"]
    table = wordbytes.Table(*wordbytes.of_list(strings))
    assert len(set(table.slot.tolist())) == 5 and table.slot[0] == table.slot[2]
    assert (table.find(*wordbytes.of_list([b"abcdefgh", b"abcdefgz"])) >= 0).tolist() == [True, False]


def resampled_by_hand(rows, target, share=25, least=20):
    features = lambda w: [*w, *map(" ".join, zip(w, w[1:]))]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    source, goal = (collections.Counter(bucket(f) for t in texts for f in features(words(t))) for texts in ([t for _, t in rows], target))
    s_all, t_all = sum(source.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000))))
    out = []
    for i, t in rows:
        found = list(map(gain, map(bucket, features(words(t)))))
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(t)) >= least])
    drawable = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(drawable[: share * len(drawable) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_importance(spark):
    rows = [*enumerate(some_texts(80)), (3, "again " * 30), (None, "no id " * 30), (None, "no id " * 30), (500, "w1 w2 " * 60_000)]
    target = [t for t in some_texts(9, seed=8)]
    got = importance.importance(docs(spark, rows), docs(spark, list(enumerate(target))))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled_by_hand(rows, target)
    drawn = importance.resampled(docs(spark, rows), docs(spark, list(enumerate(target))), share=40)
    assert drawn.columns == docs(spark, []).columns
    wanted = [(i, f) for i, f, _, _, rank in resampled_by_hand(rows, target, share=40) if rank]
    assert sorted((str(r.doc_id), max(0, 2 * len(words(r.text)) - 1)) for r in drawn.collect()) == sorted((str(i), f) for i, f in wanted)


def test_importance_of_nothing(spark):
    none = docs(spark, [])
    assert importance.importance(none, none).count() == 0
    only = importance.importance(docs(spark, [(1, None)]), none).collect()
    assert [(r.doc_id, r.n_features, r.weight, r["rank"]) for r in only] == [(1, 0, 0, None)]
    assert importance.importance(docs(spark, [(i, "same words " * 20) for i in range(8)]), none, share=100).where("rank IS NULL").count() == 0


def searched_by_hand(rows, items, k):
    terms = [(i, collections.Counter(words(t))) for i, t in rows]
    n_docs, all_terms = sum(bool(c) for _, c in terms), sum(sum(c.values()) for _, c in terms)
    df = collections.Counter(term for _, c in terms for term in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for item, asked in wanted.items():
        found = []
        for i, c in terms:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(1, all_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 5, 50])
def test_search(spark, monkeypatch, k):
    rows = [*enumerate(some_texts(300)), (4, "w3 w4"), (4, "w3 w4"), (None, "w3 w4 w5"), (None, "w3 w4 w5"), (900, "w7 " * 80_000 + "w8")]
    items = [*enumerate(some_texts(12, seed=9)), (3, "w39 more for the same item"), (None, "w1 thé 日本"), (77, "nowhere to be found"), (78, "w2 w2 w2")]
    wanted = searched_by_hand(rows, items, k)
    monkeypatch.setattr(wordbytes, "BYTES", 300)
    for block in (4_096, 5):
        monkeypatch.setattr(lexical, "ITEMS", block)
        got = lexical.search(docs(spark, rows), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string"), k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == wanted


def test_search_of_nothing(spark):
    none, items = docs(spark, []), spark.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(docs(spark, [(1, "a"), (2, "c")]), items.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in lexical.search(docs(spark, [(1, "a"), (2, "c"), (3, None)]), items).collect()] == [(1, 1, 1)]


def test_accumulators_are_limited():
    """Once a good batch has been seen, common terms make no accumulators, and nothing is lost."""
    rng, n, terms = np.random.default_rng(2), 2_000, 30
    df = np.array([3 * (i + 1) ** 2 % 1_900 + 5 for i in range(terms)])
    at = [np.sort(rng.choice(n, size, replace=False)) for size in df]
    first, text = np.concatenate([[0], np.cumsum(df)]), np.concatenate(at)
    part = rng.integers(1, 1_000_000, len(text))
    most, w = np.array([part[a:b].max() for a, b in itertools.pairwise(first)]), lexical.weight(n, df)
    item, best, made = np.arange(terms), lexical.Best(10), []
    score = np.zeros(n, np.int64)
    for t in range(terms):
        score[at[t]] += part[first[t] : first[t + 1]] * w[t]
    for _ in range(2):
        found, got = lexical.answer(item, w, part, most, first, text, n, best, made)
        assert (score[found] == got).all()
        best.add(got, found, np.zeros(len(found), bool))
    top = np.lexsort((np.arange(n), -score))[:5]
    assert set(top.tolist()) <= set(best.doc.tolist()) and made[1] < (score > 0).sum()


def test_probabilities_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    for sizes in ([1], [2], [7], [3, 0, 1, 5]):
        sizes, k = np.array(sizes), 3
        potential, start, step = langid.potentials(rng.normal(size=(4, k))), np.exp(rng.normal(size=k)), np.exp(rng.normal(size=(k, k)))
        ids, wanted, at = rng.integers(0, 4, sizes.sum()), [], 0
        for n in sizes:
            sums = np.zeros((n, k))
            for y in itertools.product(range(k), repeat=int(n)):
                p = math.prod([start[y[0]], *(potential[ids[at + i], y[i]] for i in range(n)), *(step[y[i - 1], y[i]] for i in range(1, n))]) if n else 0
                for i in range(n):
                    sums[i, y[i]] += p
            wanted.append(sums / sums.sum(axis=1, keepdims=True))
            at += n
        for lane in (1, 2, 3, 128):
            got, of = np.zeros((len(ids), k)), np.zeros(len(ids), int)
            for text, place, probability in langid.posteriors(ids, potential, sizes, start, step, lane):
                got[place], of[place] = probability, text
            assert np.allclose(got, np.concatenate(wanted)) and (of == np.repeat(np.arange(len(sizes)), sizes)).all()


def test_languages_held_out(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.languages(rows).toPandas().merge(rows.select("doc_id", "lang").toPandas())
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.95
    # no label of a held-out row and nothing but text goes in
    again = rows.withColumn("lang", importance.F.when(langid.held_out("doc_id"), "xx").otherwise(importance.F.col("lang"))).withColumn("source", importance.F.lit("?"))
    assert langid.languages(again).toPandas().sort_values("doc_id").score.tolist() == got.sort_values("doc_id").score.tolist()


ENGLISH = "the house of my brother stands near the river and we often go there with our friends when the weather is good".split()
GERMAN = "das haus meines bruders steht am fluss und wir gehen oft mit unseren freunden dorthin wenn das wetter schön ist".split()


def mixed(seed, n=200):
    rng = random.Random(seed)
    return [(lang, [rng.choice(source) for _ in range(60)]) for _ in range(n // 2) for lang, source in (("en", ENGLISH), ("de", GERMAN))]


def test_switches_within_a_text(spark):
    model = langid.fit(mixed(1))
    rng = random.Random(7)
    parts = [[rng.choice(source) for _ in range(40)] for source in (ENGLISH, GERMAN, ENGLISH)]
    text = ". ".join(" ".join(part) for part in parts)
    rows = [(1, text), (2, None), (3, "12 -- !"), (None, "wetter und freunden")]
    got = langid.language_runs(docs(spark, rows), model).orderBy("doc_id", "run").collect()
    assert [(r.doc_id, r.lang) for r in got] == [(None, "de"), (1, "en"), (1, "de"), (1, "en")]
    for r, part in zip(got[1:], parts):
        said = set(text[r.start : r.end].replace(".", "").split())
        assert len(said - set(part)) <= 1 and 0.5 < r.score <= 1


def test_languages_edges(spark):
    rows = [(1, None), (2, ""), (3, "123 ½ ... ²"), (None, "the house of my friends"), (5, "the house " * 60_000), (5, "the house " * 60_000), (6, "wir gehen oft 日本語 " + "x" * 5_000), (7, "กำ हिन्दी")]
    model = langid.fit(mixed(2))
    got = langid.languages(docs(spark, rows), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got][:6] == [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (5, "en")]
    assert got[6].lang_pred in ("de", "en") and got[7].lang_pred in ("de", "en") and all(0 <= r.score <= 1 for r in got) and not got[3].held_out
    assert got[4].n_words == 120_000 and got[0].score == 0
    # nothing to learn from: no language is known
    assert {r.lang_pred for r in langid.languages(docs(spark, rows)).collect()} == {"und"}
    assert langid.languages(docs(spark, [])).count() == 0
    one = docs(spark, [(i, "only one") for i in range(9)]).withColumn("lang", importance.F.lit("aa"))
    assert {(r.lang_pred, r.score) for r in langid.languages(one).collect()} == {("aa", 1.0)}


def test_labeller_forgets_and_goes_on(monkeypatch):
    model, texts = langid.fit(mixed(3)), [" ".join(words) for _, words in mixed(4, 8)]
    wanted = langid.Labeller(model).labels(texts)
    for kept, at_once, section in ((3, 5, 40), (25, 100_000, 1 << 20)):
        for name, value in (("KEPT", kept), ("LOOKED_UP", at_once), ("SECTION", section)):
            monkeypatch.setattr(langid, name, value)
        own = langid.Labeller(model)
        for _ in range(2):
            for one, other in zip(own.labels(texts), wanted):
                assert np.allclose(one, other)

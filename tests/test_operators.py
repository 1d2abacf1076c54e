import random

import pytest
from pyspark.sql import functions as F

from rowloom.functions.jsonx import record_payload
from rowloom.operators import changes, index, ingest, metrics, pack, transcripts


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_index(spark, parts):
    ids = random.Random(3).sample(range(10_000), 500)
    out = index.dense_index(spark.createDataFrame([(i,) for i in ids], "id long").repartition(parts), "id", buckets=5)
    assert [(r.id, r.rn) for r in out.orderBy("rn").collect()] == [(x, n) for n, x in enumerate(sorted(ids), 1)]


def test_batches_resume(spark):
    out = index.batches(spark.range(10), 4, "id", after=3)
    assert rows(out) == [(i, i + 1, i // 4) for i in range(3, 10)]


def test_append_renumbered(spark):
    old = spark.createDataFrame([(1, "b"), (2, "c")], "STT int, name string")
    new = spark.createDataFrame([("a", "x")], "name string, extra string")
    assert rows(index.append_renumbered(old, new, "name").select("STT", "name", "extra")) == [(1, "b", None), (2, "c", None), (3, "a", "x")]


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None)], "id string, version int, rating string")
    assert rows(index.latest_by(df, "id", "version")) == [("a", 3, "y"), ("b", 2, None)]
    assert rows(index.first_by(df, "id", "version")) == [("a", 1, "x"), ("b", 2, None)]


def test_changes(spark):
    stored = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", None, 1), ("c", "5", 1)], "id string, rating string, version int")
    current = spark.createDataFrame([("a", "1"), ("b", None), ("c", None), ("d", None)], "id string, rating string")
    assert rows(changes.new_or_changed(current, stored, "id", "rating", "version")) == [("a", "1", "changed"), ("c", None, "changed"), ("d", None, "new")]
    same = spark.createDataFrame([("a", "2")], "id string, rating string")
    assert rows(changes.new_or_changed(same, stored, "id", "rating", "version")) == []


def test_changed_json(spark):
    stored = spark.createDataFrame([(1, '{"rate":{"rating":"up"}}'), (2, "{bad"), (3, '{"rate":null}')], "id int, m string")
    current = spark.createDataFrame([(1, '{"rate":{"rating":"down"}}'), (2, '{"rate":{"rating":"up"}}'), (3, '{"rate":{}}')], "id int, m string")
    assert [r.id for r in changes.changed_json(current, stored, "id", "m", "rate", "rating").collect()] == [1]


def test_ingest(spark):
    df = spark.createDataFrame([("7", 0), ("7", 1), ("8", 0), ("9", 0)], "id string, pos int")
    stored = spark.createDataFrame([(8,)], "id long")
    assert rows(ingest.incremental_first(df, stored, "id", "pos")) == [("7", 0), ("9", 0)]
    base = spark.createDataFrame([("a", "old"), ("b", None)], "k string, t string")
    new = spark.createDataFrame([("a", "n1"), ("b", "n2")], "k string, t string")
    assert rows(ingest.keyed_update(base, new, "k", "t")) == [("a", "old"), ("b", "n2")]
    assert rows(ingest.keyed_update(base, new, "k", "t", overwrite=True)) == [("a", "n1"), ("b", "n2")]
    assert rows(ingest.keyed_update(base.drop("t"), new, "k", "t")) == [("a", "n1"), ("b", "n2")]
    with pytest.raises(ValueError):
        ingest.require_columns(base, "k", "nope")
    with pytest.raises(ValueError):
        ingest.coalesce_aliases(base, {"x": ["nope"]})
    long, short = ingest.split_short(spark.createDataFrame([(2.0,), (2.1,), (None,)], "d double"), "d")
    assert (long.count(), short.count()) == (1, 1)


def test_id_prefix(spark):
    df = spark.createDataFrame([("id7id",), ("7",)], "c string")
    assert [r[0] for r in df.select(ingest.without_id_prefix(F.col("c"))).collect()] == ["7", "7"]
    assert spark.range(1).select(ingest.id_of_file(F.lit("user_123.mp4"))).first()[0] == "123"


def test_segments(spark):
    raw = """[{'speaker': 'A', 'start_time': 1000, 'end_time': 2, 'text': 'hi'}, {'speaker': 'A', 'start_time': 2000, 'end_time': 3, 'text': "it's"}, {'speaker': 'A', 'text': ''}]"""
    df = spark.createDataFrame([("s", raw)], "session_id string, output string")
    assert [r.text for r in transcripts.segments(df, "output", "session_id").collect()] == ["hi"]
    assert [r.text for r in transcripts.segments(df, "output", "session_id", mode="lenient").collect()] == ["hi", "it's"]


def test_merge_ties(spark):
    df = spark.createDataFrame([("s", "Mentor", 0, 1900, "m"), ("s", "Mentee", 0, 1200, "e"), ("s", "Mentor", 1, 1200, "n")], "session_id string, role string, pos int, start_time long, text string")
    rank = lambda first: F.when(F.col("role") == first, 0).otherwise(1)
    by_ms = transcripts.merged_lines(df, rank("Mentor"), "session_id").first().transcript
    by_s = transcripts.merged_lines(df, rank("Mentee"), "session_id", by="s").first().transcript
    assert by_ms == "[00:00:01] Mentor: n\n[00:00:01] Mentee: e\n[00:00:01] Mentor: m"
    assert by_s == "[00:00:01] Mentee: e\n[00:00:01] Mentor: m\n[00:00:01] Mentor: n"


def test_windows(spark):
    body = "\nno stamp\n[00:00:10] A: x\n[0:04:15] A: short hour\nlate [00:05:00] B: y\n"
    df = spark.createDataFrame([("s", body)], "session_id string, transcript string")
    lines = transcripts.transcript_lines(df, "transcript", "session_id")
    assert [(r.ts_s) for r in lines.orderBy("pos").collect()] == [10, 300]
    assert transcripts.transcript_lines(df, "transcript", "session_id", strict_hours=False).count() == 3
    wanted = spark.createDataFrame([("s", "warm_up", 100, 130), ("s", "none", 1000, 1001), ("s", "open", None, 3)], "session_id string, section string, start_s long, end_s long")
    assert rows(transcripts.section_windows(lines, wanted, "session_id", pad=120)) == [("s", "warm_up", "[00:00:10] A: x")]
    assert rows(transcripts.section_windows(lines, wanted, "session_id", pad=170))[0][2].count("\n") == 1


def test_role_lines(spark):
    df = spark.createDataFrame([(1, "A: one A: two\n\n A: lead\nC: no\nB:x ")], "id int, t string")
    assert rows(transcripts.role_lines(df, "t", {"a": "A:", "b": "B:"}, "id")) == [(1, 0, "a", "one A: two"), (1, 4, "b", "x")]


def test_subtitles(spark):
    df = spark.createDataFrame([(1, '<transcript><text start="1.5" dur="2">a &amp; b</text><text>c</text></transcript>'), (2, "<bad")], "id int, xml string")
    assert rows(transcripts.subtitle_lines(df, "xml", "id")) == [(1, 0, 1.5, "a & b"), (1, 1, 0.0, "c")]


def fold(texts, most):
    parts, cur, size = [], [], 0
    for t in texts:
        if cur and size + len(t) + 2 > most:
            parts.append(cur)
            cur, size = [], 0
        cur.append(t)
        size += len(t) + 2
    return parts + [cur] * bool(cur)


@pytest.mark.parametrize("parts", [1, 7])
def test_greedy_parts(spark, parts):
    rng = random.Random(5)
    data = [(k, i, "x" * rng.choice([0, 3, 8, 30])) for k in range(6) for i in range(40)]
    df = spark.createDataFrame(data, "k int, pos int, text string").repartition(parts)
    wanted = sorted((k, n, len(p), "\n\n".join(p)) for k in range(6) for n, p in enumerate(fold([t for kk, _, t in data if kk == k], 20), 1))
    assert sorted(map(tuple, pack.greedy_parts(df, "k", "pos", "text", most=20).collect())) == wanted
    assert sorted(map(tuple, pack.greedy_parts_long(df, "k", "pos", "text", most=20).collect())) == wanted
    wide = pack.part_columns(pack.greedy_parts(df, "k", "pos", "text", most=20), "k", 2)
    assert wide.columns == ["k", "n_parts", "comments_1", "comments_2"] and wide.count() == 6


def test_chunk_merges(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(1, 9)], "id long, text string")
    one = rows(pack.chunk_merges(df.repartition(7), "id", "text", 3, 20))
    assert one == rows(pack.chunk_merges(df, "id", "text", 3, 20)) and len(one) == 20
    for _, ids, joined in one:
        numbers = list(map(int, ids.split(", ")))
        assert len(set(numbers)) == 3 and numbers == sorted(numbers) and joined == "\n-----------\n".join(f"t{i}" for i in numbers)
    assert rows(pack.chunk_merges(df, "id", "text", 8, 2))[0][1] == "1, 2, 3, 4, 5, 6, 7, 8"
    with pytest.raises(ValueError):
        pack.chunk_merges(df, "id", "text", 9, 1)


def test_until_blanks(spark):
    said = ["a", None, "b", None, None, "c", None, None, None, "d"]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(said)] + [("t", 0, "z")], "script string, pos int, text string")
    assert rows(pack.until_blanks(df, "script", "pos", F.col("text").isNull())) == [("s", 0, "a"), ("s", 2, "b"), ("s", 5, "c"), ("t", 0, "z")]


def test_thresholds(spark):
    df = spark.createDataFrame([(0.45, 0.5), (0.35, 0.2), (0.30, 0.30), (0.4, 0.25)], "child double, age double")
    got = [tuple(r[0]) for r in df.select(metrics.label_threshold(F.col("child"), F.col("age"), 0.4, 0.25)).collect()]
    assert got == [("child", 0.45), ("child", 0.2), ("adult", 0.7), ("adult", 0.6)]


def test_report_of_nothing(spark):
    empty = spark.createDataFrame([], "t string, p string")
    assert {r.name: r.f1 for r in metrics.class_report(empty, "t", "p", ["a", "b"]).collect()} == {"a": 0.0, "b": 0.0, "accuracy": 0.0, "macro avg": 0.0, "weighted avg": 0.0}
    stats = metrics.label_stats(spark.createDataFrame([], "label string, status string"))
    assert {r.metric: r.value for r in stats.collect()}["child_rate"] == "0.00%"


def test_payload(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert record_payload(df, F.lit(0), "a", "b").first().payload == '{"records":[{"fields":{"a":"1","b":"None"}},{"fields":{"a":"2","b":"x"}}]}'
    assert record_payload(df, F.lit(0), "a", "b", null_text=None).first().payload == '{"records":[{"fields":{"a":"1"}},{"fields":{"a":"2","b":"x"}}]}'

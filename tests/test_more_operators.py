"""Operators that the registered queries touch only in part."""

import pytest
from pyspark.sql import functions as F

from rowloom.functions import jsonx, text
from rowloom.operators import changes, index, ingest, metrics, transcripts


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_union_and_layout(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert rows(ingest.union_by_name(a, b)) == [(1, "x", None), (2, None, "y")]
    out = ingest.publish_layout(a, {"id": "ID"}, ["a", "ID", "hashtags"])
    assert out.columns == ["a", "ID", "hashtags"] and rows(out) == [("x", 1, None)]


def test_flatten_defaults(spark):
    df = spark.createDataFrame([((None, [("u",)]), 1), (None, 2)], "s struct<n: long, items: array<struct<url: string>>>, id int")
    out = ingest.flatten(df, {"id": ("id", None), "n": ("s.n", 0), "url": ("s.items[0].url", "none")})
    assert rows(out) == [(1, 0, "u"), (2, 0, "none")]


def test_insert_ignore_defaults(spark):
    stored = spark.createDataFrame([("a", "kept")], "url string, criteria string")
    new = spark.createDataFrame([("a", "no", 0), ("b", "", 0), ("b", "late", 1), ("c", None, 0)], "url string, criteria string, pos int")
    out = ingest.insert_ignore(stored, new, "url", "pos", defaults={"criteria": "Pending analysis"})
    assert rows(out) == [("a", "kept"), ("b", "Pending analysis"), ("c", "Pending analysis")]


def test_rated_rows(spark):
    log = spark.createDataFrame([(1, "tool", '{"rate": null}'), (2, "llm", '{"rate": {}}'), (3, "tool", "{}")], "id int, node_type string, m string")
    assert [r.id for r in changes.rated_rows(log, "m", condition=F.col("node_type") == "tool").collect()] == [1]
    out = changes.rating_projection(log, "m", {"rating": ("rate", "rating")}, "id")
    assert out.columns == ["id", "rating"] and out.count() == 3


def test_keyword_split(spark):
    df = spark.createDataFrame([("gọi TDV ngay",), ("tdvx none",), (None,)], "c string")
    group, rest = ingest.keyword_split(F.col("c"), ["tdv", "c2"])
    assert [tuple(r) for r in df.select(group, rest).collect()] == [("keyword", "gọi ngay"), ("none", "tdvx none"), ("no text", None)]


def test_missing_sections(spark):
    df = spark.createDataFrame([("s", '{"warm_up": {"start": "1", "end": "2"}, "lead-in": {"start": "1"}}'), ("t", None)], "id string, j string")
    got = rows(transcripts.missing_sections(df, "j", "id", ["warm_up", "lead_in"]))
    assert got == [("s", "lead_in"), ("t", "lead_in"), ("t", "warm_up")]


def test_prompts(spark):
    one = spark.range(1)
    made = one.select(text.content_prompt(F.lit("p"), F.lit(""), F.lit(None).cast("string"))).first()[0]
    assert made == "Post: p\nTranscript: Không có\nComments: Không có"
    assert one.select(jsonx.joined_purpose(F.lit('["a","b"]'))).first()[0] == "a, b"
    assert one.select(text.channel_id_in_page(F.lit('x"channelId":"UC' + "b" * 22 + '"'))).first()[0] == "UC" + "b" * 22
    windows = spark.createDataFrame([("s", "icq_1", "w"), ("s", "icq_2", " ")], "id string, section string, `window` string")
    prompts = spark.createDataFrame([("icq", "t", "ask"), ("icq", "u", "")], "family string, tag string, prompt string")
    assert rows(transcripts.score_requests(windows, prompts, "id")) == [("s", "icq_1_t", "ask", "w")]


def test_report_values(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "a")] * 2
    report = {r.name: r for r in metrics.class_report(spark.createDataFrame(pairs, "t string, p string"), "t", "p", ["a", "b"]).collect()}
    assert report["a"].precision == pytest.approx(3 / 5) and report["a"].recall == pytest.approx(3 / 4)
    assert report["accuracy"].f1 == pytest.approx(5 / 8) and report["macro avg"].precision == pytest.approx((3 / 5 + 2 / 3) / 2)


def test_keywords_are_plain_text(spark):
    df = spark.createDataFrame([("i like C++, really",), ("i like c",), ("a ( b) c",), ("cc++",), (None,)], "t string")
    group, stripped = ingest.keyword_split(F.col("t"), ["c++", "(", ""])
    rows = df.select("t", group.alias("g"), stripped.alias("s")).collect()
    assert [r.g for r in rows] == ["keyword", "none", "keyword", "none", "no text"]
    assert [r.s for r in rows] == ["i like , really", "i like c", "a b) c", "cc++", None]
    assert {r[0] for r in df.select(ingest.keyword_split(F.col("t"), [])[0]).collect()} == {"none", "no text"}
    shares = {r.keyword_group: (r.n, r.percent) for r in ingest.keyword_shares(df, "t", ["c++", "("]).collect()}
    assert shares == {"keyword": (2, 40.0), "none": (2, 40.0), "no text": (1, 20.0)}
    assert ingest.keyword_shares(df.limit(0), "t", ["x"]).count() == 0


def test_kind_of_name_ignores_case(spark):
    df = spark.createDataFrame([("My CLIP.mp4",), ("song",), (None,)], "n string")
    assert [r[0] for r in df.select(ingest.kind_of_name(F.col("n"), [("Clip", "video"), ("SONG", "audio")])).collect()] == ["video", "audio", None]


def test_index_over_equal_first_columns(spark):
    df = spark.createDataFrame([(1, i) for i in range(500)] + [(0, 7), (2, 8)], "a int, b int")
    got = index.dense_index(df, "a", "b").orderBy("rn").collect()
    assert [r.rn for r in got] == list(range(1, 503)) and [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got)


def test_paired_names_against_all_pairs(spark):
    videos = [(1, "ab"), (1, "abc"), (2, "ab"), (2, ""), (3, "a much longer base than any name"), (1, "HV")]
    audio = [(1, "abc HV"), (1, "xab mentor"), (1, "abab HV"), (2, "ab mentor HV"), (2, "mentor ab"), (2, "a"), (1, "HV mentor"), (3, "")]
    got = transcripts.paired_names(spark.createDataFrame(videos, "f int, base string"), spark.createDataFrame(audio, "f int, name string"), "f").collect()
    wanted = set()
    for f, base in videos:
        names = [n for g, n in audio if g == f and base and base in n]
        first, second = max((n for n in names if "HV" in n), default=None), max((n for n in names if "HV" not in n and "mentor" in n), default=None)
        if first and second:
            wanted.add((f, base, first, second))
    assert {tuple(r) for r in got} == wanted and wanted
    none = spark.createDataFrame([], "f int, base string")
    assert transcripts.paired_names(none, spark.createDataFrame(audio, "f int, name string"), "f").count() == 0


def test_answers_with_given_keys_and_what_is_dropped(spark):
    rows = [(1, '```json\n[{"a": 1}, 5, {"b": "x"}]\n```'), (2, "{broken"), (3, '{"a": null}'), (4, None), (5, "[]"), (6, "7")]
    df = spark.createDataFrame(rows, "id int, answer string")
    got = jsonx.answers_table(df, "answer", "id", keys=["b", "zz"]).orderBy("id", "pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, None, None), (1, 2, "x", None), (3, 0, None, None)]
    assert tuple(jsonx.answers_dropped(df, "answer").first()) == (6, 3, 4, 1)
    assert tuple(jsonx.answers_dropped(df.limit(0), "answer").first()) == (0, 0, 0, 0)


def test_failures_and_days(spark):
    df = spark.createDataFrame([(1, "SUCCESS: 2"), (2, "ERROR: x"), (3, None)], "id int, status string")
    assert [r.id for r in metrics.failures(df, "status").collect()] == [2, 3]
    calls = spark.createDataFrame([("2025-01-01 00:00:00", 61), ("2025-01-01 09:00:00", 100), ("2025-01-02 00:00:00", 60)], "at string, s int")
    days = metrics.calls_per_day(metrics.long_calls(calls, "at", F.col("s"))).collect()
    assert [(str(r.day), r.n_calls, r.seconds) for r in days] == [("2025-01-01", 2, 161)]

"""Windows of long sessions, containment of names and answers' keys, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from rowloom.functions import jsonx
from rowloom.operators import transcripts


@pytest.mark.parametrize("bin_seconds, block", [(1, 2), (50, 7), (600, 4_096)])
def test_windows_against_brute_force(spark, bin_seconds, block):
    rng = random.Random(bin_seconds)
    lines = [(s, i, rng.randrange(900), f"{s}.{i}") for s, n in (("hot", 150), ("b", 20), ("c", 1), (None, 3)) for i in range(n)]  # stamps in no order
    wanted = [(s, f"sec{i}", rng.choice([None, *range(0, 1_000, 7)]), rng.choice([None, 5, 300, 10**12])) for s in ("hot", "b", "c", "none", None) for i in range(8)]
    wanted = [(s, n, a, None if a is None or b is None else a + b) for s, n, a, b in wanted]
    got = transcripts.section_windows(spark.createDataFrame(lines, "k string, pos int, ts_s long, line string"), spark.createDataFrame(wanted, "k string, section string, start_s long, end_s long"), "k", 20, bin_seconds, block)
    assert got.columns == ["k", "section", "window"]
    expected = {}
    for s, name, a, b in wanted:
        if s is not None and a is not None and b is not None:
            inside = [line for k, _, ts, line in sorted(x for x in lines if x[0] is not None) if k == s and max(0, a - 20) <= ts <= b + 20]
            if inside:
                expected[s, name] = "\n".join(inside)
    assert {(r.k, r.section): r.window for r in got.collect()} == expected


def test_a_long_session_is_dealt_by_bins(spark):
    lines = spark.range(1_000).select(F.lit("one").alias("k"), F.col("id").alias("pos"), F.col("id").alias("ts_s"), F.lit("x").alias("line"))
    wanted = spark.createDataFrame([("one", "all", 0, 10**6)], "k string, section string, start_s long, end_s long")
    text = transcripts.section_windows(lines, wanted, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "FLOOR((cast(ts_s" in text and "_bin" in text and "_block" in text


def paired_by_hand(videos, audio):
    out = set()
    for folder, base in videos:
        if folder is None or not base:
            continue
        names = [n for f, n in audio if f == folder and n is not None and base in n]
        first = max((n for n in names if "HV" in n), default=None)
        second = max((n for n in names if "HV" not in n and "mentor" in n), default=None)
        if first and second:
            out.add((folder, base, first, second))
    return sorted(out)


@pytest.mark.parametrize("gram", [1, 3, 5])
def test_pairs_against_brute_force(spark, gram):
    rng = random.Random(gram)
    piece = lambda n: "".join(rng.choice("abé1") for _ in range(n))
    videos = [(rng.choice(["x", "y", None]), piece(rng.randrange(0, 6))) for _ in range(60)] + [("x", None), ("x", "ab"), ("x", "ab"), ("z", "long.base*name"), ("z", "HV")]
    audio = [(rng.choice(["x", "y", None]), piece(rng.randrange(1, 8)) + rng.choice([" HV", " mentor", " mentor HV", ""]) + piece(2)) for _ in range(150)]
    audio += [("x", None), ("x", ""), ("z", "a long.base*name HV.wav"), ("z", "long.base*name mentor"), ("z", "longxbase*name mentor"), ("z", "ab")]
    got = transcripts.paired_names(spark.createDataFrame(videos, "f string, base string"), spark.createDataFrame(audio, "f string, name string"), "f", gram)
    assert got.columns == ["f", "base", "first_role", "second_role"]
    assert sorted(map(tuple, got.collect())) == paired_by_hand(videos, audio)


def test_names_are_indexed_in_linear_size(spark):
    """The index has a row for each piece, no action is needed to build the plan, and it is joined by equality."""
    audio = spark.createDataFrame([("x", "q" * 10 + "".join(map(chr, range(97, 123))) + " HV")], "f string, name string")
    videos = spark.createDataFrame([("x", "abc")], "f string, base string")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    got = transcripts.paired_names(videos, audio, "f")
    assert len(tracker.getJobIdsForGroup(None)) == before
    text = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("NestedLoop", "Cartesian", "Python"))


def test_pairing_names_broadcasts_nothing(spark):
    """Not even when the sizes at run time would have joins changed: the driver's memory must not depend on the tables."""
    import __spark_entry__ as entry

    got = entry.queries()["name_pairing"](spark, "/root/testdata/sf0.001")
    assert got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text and "SortMergeJoin" in text and "Broadcast" not in text


def test_answers_are_parsed_once(spark):
    rows = [(1, '```json\n[{"a": 1, "b": "x"}, 5, {"c": null}]\n```'), (2, '{"b": [1, "y"], "d": {"e": 1}}'), (3, "{broken"), (4, None), (5, "[]"), (6, '["{\\"z\\": 1", {}]')]
    df = spark.createDataFrame(rows, "id long, answer string")
    got = jsonx.answers_table(df, "answer", "id")
    assert got.columns == ["id", "pos", "a", "b", "c", "d"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, "1", "x", None, None), (1, 2, None, None, None, None), (2, 0, None, '[1,"y"]', None, '{"e":1}'), (6, 1, None, None, None, None)]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "json" not in text.lower().replace("jsonx", "") or "from_json" not in text
    assert jsonx.answers_table(df, "answer", "id", keys=["b", "q"]).columns == ["id", "pos", "b", "q"]
    with pytest.raises(ValueError):
        jsonx.answers_table(df, "answer", "id", most_columns=3)
    assert jsonx.answers_table(df.limit(0), "answer", "id").columns == ["id", "pos"]

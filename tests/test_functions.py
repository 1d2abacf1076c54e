import datetime

import pytest
from pyspark.sql import functions as F

from rowloom.functions import html, jsonx, text, timefmt


def values(spark, rows, make, schema="c string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(make.alias("v")).collect()]


C = F.col("c")


@pytest.mark.parametrize("given, wanted", [
    ("a\nb", "ab"), ("a / b", "a  b"), ('say "hi"?', "say hi"), (" \t ", None), ("“curly”", "“curly”"), (None, None), ("x\u00a0\u00a0y", "x y"),
])
def test_clean_text(spark, given, wanted):
    assert values(spark, [given], text.clean_text(C)) == [wanted]


def test_fences(spark):
    two = "x\n```json\n{1}\n```\n```json\n{2}\n```"
    assert values(spark, [two, "bare", None], text.fenced_json(C)) == ["{1}", "bare", None]
    assert values(spark, ["```json\n[1]\n```", "[2]", "  "], text.unfenced(C)) == ["[1]", "[2]", ""]


def test_video_id(spark):
    urls = ["@https://www.youtube.com/watch?v=abc&t=1", "youtube.com/watch?t=2&v=d-_", "youtu.be/xyz", "https://youtu.be/q?t=1", "https://example.org/watch?v=1", "youtube.com/embed/z", "not a url"]
    assert values(spark, urls, text.video_id(C)) == ["abc", "d-_", "xyz", "q", None, None, None]


def test_playlist_id(spark):
    urls = ["https://www.youtube.com/watch?v=a&list=PL12", "youtube.com/playlist%253Flist%253DPLx", "https://youtube.com/playlist/PLpath", "example.org/?list=PL1", "", None]
    assert values(spark, urls, text.playlist_id(C)) == ["PL12", "PLx", "PLpath", None, None, None]


def test_decoded_until_nothing_changes(spark):
    from urllib.parse import quote

    shown = ["youtube.com/playlist?list=PLdeep", "a+b é ß/25", "25 25"]
    for plain in shown:
        texts = [plain]
        for _ in range(9):
            texts.append(quote(texts[-1], safe=""))
        assert values(spark, texts, text.decoded_url(C)) == [plain] * 10
    assert values(spark, ["", None, "100%", "%zz%20"], text.decoded_url(C)) == ["", None, "100%", "%zz%20"]
    assert values(spark, [quote(quote(quote(quote(shown[0]))))], text.playlist_id(C)) == ["PLdeep"]


def test_channel_ref(spark):
    raw = "UC" + "a" * 22
    urls = [raw, f"https://www.youtube.com/channel/{raw}", "youtube.com/c/own", "youtube.com/user/u1", "https://youtube.com/@h_1/videos", "short", None]
    got = values(spark, urls, F.to_json(text.channel_ref(C)))
    assert [g and tuple(__import__("json").loads(g).values()) for g in got] == [("channel", raw), ("channel", raw), ("custom", "own"), ("user", "u1"), ("handle", "h_1"), None, None]


def test_small_strings(spark):
    assert values(spark, ["https://t/@bob/video/1", "https://t/bob"], text.user_name(C)) == ["bob", None]
    assert values(spark, ["Bản sao của a.b.mp4", "noext", ".hidden"], text.base_name(C)) == ["a.b", "noext", ".hidden"]
    assert values(spark, ["abcdef", "abc"], text.capped(C, 3)) == ["abc\n[...]", "abc"]
    assert values(spark, [None], text.comment_line(C, F.lit("t"))) == ["[]\n[t]"]


def test_image_prompt(spark):
    assert values(spark, ["Why does water boil water"], F.array_join(text.key_concepts(C), ",")) == ["does,water,boil"]
    made = values(spark, ["What boils"], text.image_prompt(C, F.lit("water"), "no such style"))[0]
    assert "clean, flat" in made and "including what, boils, water with" in made
    assert values(spark, [""], text.image_prompt(C, F.lit("a"))) == [None]


@pytest.mark.parametrize("given, wanted", [("10:28", 628), ("1:02:03", 3723), ("45", 0), ("", 0), (None, 0), ("2:0", 120), ("a:b", 0)])
def test_length_seconds(spark, given, wanted):
    assert values(spark, [given], timefmt.length_seconds(C)) == [wanted]


def test_clocks(spark):
    assert values(spark, [(0,), (3_661_999,), (360_000_000,)], timefmt.ms_clock(C), "c long") == ["00:00:00", "01:01:01", "100:00:00"]
    assert values(spark, [(59,), (86_400,), (200_000,)], timefmt.span_clock(C), "c long") == ["0:00:59", "1 day, 0:00:00", "2 days, 7:33:20"]
    assert values(spark, ["01:02:03", "x:1:2", None], timefmt.stamp_seconds(C)) == [3723, None, None]
    assert values(spark, [(1_700_000_000,)], timefmt.epoch_text(C, "Asia/Ho_Chi_Minh"), "c long") == ["2023-11-15 05:13:20"]


def test_relative_date(spark):
    now = F.lit("2025-03-01 10:00:00").cast("timestamp")
    got = values(spark, ["3 weeks ago", "11 hours ago", "Streamed 2 months ago", "1 year ago", "yesterday", "", None], timefmt.relative_date(C, now))
    d = datetime.date
    assert got == [d(2025, 2, 8), d(2025, 2, 28), d(2024, 12, 31), d(2024, 3, 1), d(2025, 3, 1), d(2025, 3, 1), d(2025, 3, 1)]


def test_counts(spark):
    assert values(spark, ["2.19M subscribers", "512K subscribers", "87 subscribers", "", "n/a", None, "1.1B"], timefmt.short_count(C)) == [2190000, 512000, 87, 0, 0, 0, 1100000000]
    assert values(spark, ["7,138 views", "No views", None], timefmt.digits_count(C)) == [7138, 0, 0]
    assert values(spark, [f"{i / 100:.2f}M" for i in range(1, 1000)], timefmt.short_count(C)) == [i * 10_000 for i in range(1, 1000)]


def test_json_keys(spark):
    rows = ['{"rate":null}', '{"rate":{}}', "{}", '["rate"]', "{bad", None]
    assert values(spark, rows, jsonx.json_has_key(C, "rate")) == [True, True, False, True, False, False]
    assert values(spark, ['{"user_inputs":{"#a.b#":"x"}}'], jsonx.json_text(C, "user_inputs", "#a.b#")) == ["x"]


def test_bullets(spark):
    given = '{"a":"x","b":["1","2"],"c":3}'
    assert values(spark, [given, "plain"], jsonx.bullets(C)) == ["- a: x\n- b:\n  + 1\n  + 2\n- c: 3", "plain"]
    assert values(spark, [given], jsonx.listed_values(C)) == ["1, 2"]
    assert values(spark, ['["p","q"]', given, "t"], jsonx.needs(C)) == ["- p\n- q", "- a: x\n- b:\n  + 1\n  + 2\n- c: 3", "t"]
    assert values(spark, ['{"insights":"z"}', '["f","g"]', "s", "[]", "{}", None], jsonx.insight(C)) == ["z", "f", "s", "no information", "no information", "no information"]


def test_answers_table(spark):
    rows = [(1, '```json\n[{"b":1,"a":"x"},7]\n```'), (2, '{"c":[1,2]}'), (3, "{broken"), (4, None), (5, '[{"a":null}]')]
    out = jsonx.answers_table(spark.createDataFrame(rows, "row_id long, answer string"), "answer", "row_id")
    assert out.columns == ["row_id", "pos", "b", "a", "c"]
    assert sorted(map(tuple, out.collect())) == [(1, 0, "1", "x", None), (2, 0, None, None, "[1,2]"), (5, 0, None, None, None)]
    with pytest.raises(ValueError):
        jsonx.answers_table(spark.createDataFrame(rows, "row_id long, answer string"), "answer", "row_id", most_columns=2)


def test_sections(spark):
    rows = [("s", '{"lead-in":{"start":"00:01:00","end":"00:02:00"},"x":{"start":"5"},"y":{"start":"7","end":"9"}}'), ("t", "bad")]
    out = jsonx.sections(spark.createDataFrame(rows, "session_id string, sections string"), "sections", "session_id")
    assert sorted((r.section, r.start_s, r.end_s, r.missing) for r in out.collect()) == [("lead_in", 60, 120, False), ("x", 5, None, True), ("y", 7, 9, False)]


def test_page_fields(spark):
    page = '<html lang="en"><title>T</title><li>a <b>b</b></li><devsite-video video-id="v1"><iframe src="https://www.youtube.com/embed/v1?x"></iframe></devsite-video><iframe src="https://www.youtube.com/embed/v2"></iframe><dt>k</dt><dd>v</dd>'
    fields = html.page_fields(C)
    watch = "https://www.youtube.com/watch?v="
    assert values(spark, [page], fields["title"]) == ["T"]
    assert values(spark, [page, ""], html.list_items(fields)) == ["a b", "Tools information not available"]
    # within a video's element the frame is listed as well; of other frames those that are not there yet
    assert values(spark, [page], fields["videos"]) == [[f"{watch}v1", f"{watch}v1", f"{watch}v2"]]
    assert values(spark, [page], fields["labels"]) == [["k: v"]]
    assert values(spark, [page, None], fields["description"]) == ["Description not available", None]


VARIANTS = [
    ("<HTML LANG='vi'>", "lang", "vi"), ("<html class=a lang=de >", "lang", "de"), ("<p>x", "lang", None),
    ("<TITLE>\n A &amp;  B&eacute; </TITLE>", "title", "A & Bé"), ("<title>one</title><title>two</title>", "title", "one"), ("<!-- <title>no</title> -->", "title", ""), ("<title>open", "title", "open"),
    ("<meta content=\"c's\" name='Description'>", "description", "c's"), ('<META CONTENT=one NAME=description><meta name="description" content="two">', "description", "one"), ("<meta property=description content=x>", "description", "Description not available"),
    ("<h1 class='a>b'>x<br>y</h1><H1>z</H1>", "headings", ["xy", "z"]), ("<script>'<h1>no</h1>'</script><style><h1>no</h1></style>", "headings", []),
    ("<ul><li>a<li>b <ul><li>c</ul> d</ul><li>e", "items", ["a", "c", "b c d", "e"]), ("<ol><li>1</ol>tail", "items", ["1"]), ("<li>a<script>x</script>b", "items", ["ab"]),
    ("<a name=x>no</a><A HREF='/p?a=1&amp;b=2'>1</A><a class=c href=/q>2</a><a href=/q>3</a>", "links", ["/p?a=1&b=2", "/q"]),
    ("<dl><dt>a<dd>1<dt>b</dt><dd> 2\n3 </dl><dd>no term</dd>", "labels", ["a: 1", "b: 2 3"]), ("<dt>k<dt>l<dd>v<dd>w", "labels", ["l: v"]),
    ("<iframe src='https://www.youtube.com/embed/q'></iframe><iframe src='https://other.org/embed/q'></iframe><iframe></iframe>", "videos", ["https://www.youtube.com/watch?v=q"]),
    ("<", "items", []), ("<li" * 200 + "&#0;" + "</" * 50, "headings", []),
]


@pytest.mark.parametrize("page, field, wanted", VARIANTS)
def test_page_variants(page, field, wanted):
    found = dict(zip(html.FIELDS.names, html._Page(page).fields()))
    assert found[field] == wanted

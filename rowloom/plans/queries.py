"""Registered queries and the same in DuckDB SQL, over the whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.functions import html, jsonx, text, timefmt
from rowloom.operators import changes, index, ingest, metrics, pack, transcripts
from rowloom.sources import readers, runs, shared, writers
from rowloom.streaming import feed

QUERIES = {}
SQL = {}


def registered(sql: str | None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- ratings -------------------------------------------------------------------------------------------------------

OLD = "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN concat('was ', event_type) ELSE event_type END AS rating FROM events WHERE event_id % 10 <> 0"


def old_ratings(events: DataFrame) -> DataFrame:
    """An earlier snapshot: without every tenth event, and every seventh rated otherwise."""
    was = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("was "), F.col("event_type"))).otherwise(F.col("event_type"))
    return events.where("event_id % 10 <> 0").select("event_id", was.alias("rating"))


@registered("""SELECT event_id, user_id, props->>'$.k' AS rating, json_exists(props, '$.k') AS rated FROM events WHERE event_type = 'purchase'""")
def rating_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return rows.select("event_id", "user_id", jsonx.json_text(F.col("props"), "k").alias("rating"), jsonx.json_has_key(F.col("props"), "k").alias("rated"))


@registered("""WITH e AS (SELECT event_id, user_id || ' ' || strftime(ts, '%Y-%m-%d') AS run, event_type, value FROM events) SELECT * FROM e WHERE run IN (SELECT run FROM e WHERE event_type = 'error')""")
def rated_run_rows(spark, sf_dir):
    """A user's day is a run; those with an error are wanted."""
    run = F.concat_ws(" ", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    events = table(spark, sf_dir, "events").select("event_id", run.alias("run"), "event_type", "value")
    return changes.rows_of_runs(events, events.where("event_type = 'error'"), "run").select("event_id", "run", "event_type", "value")


@registered(f"""SELECT e.event_id, e.event_type AS rating, CASE WHEN o.event_id IS NULL THEN 'new' ELSE 'changed' END AS change_type
FROM events e LEFT JOIN ({OLD}) o USING (event_id) WHERE o.event_id IS NULL OR o.rating IS DISTINCT FROM e.event_type""")
def rating_changes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return changes.new_or_changed(events.select("event_id", F.col("event_type").alias("rating")), old_ratings(events), "event_id", "rating")


@registered("""SELECT event_id, props FROM events WHERE event_id % 7 = 0 AND event_id % 10 <> 0 AND event_id % 11 <> 0""")
def rating_changes_json(spark, sf_dir):
    """The stored side has another k on every seventh row and does not parse on every eleventh."""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    k = jsonx.json_text(F.col("props"), "k")
    stored = F.when(F.col("event_id") % 11 == 0, "{broken").when(F.col("event_id") % 7 == 0, F.format_string('{"k": "was %s"}', k)).otherwise(F.col("props"))
    return changes.changed_json(events, events.where("event_id % 10 <> 0").select("event_id", stored.alias("props")), "event_id", "props", "k")


@registered("""SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def state_latest(spark, sf_dir):
    return index.latest_by(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@registered("""SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 50 = 0)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def incremental_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return ingest.incremental_first(events, events.where("event_id % 50 = 0"), "user_id", "event_id")


@registered("""WITH s AS (SELECT DISTINCT user_id, 'Pending analysis' AS note FROM events WHERE event_id % 50 = 0),
n AS (SELECT user_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS note FROM events WHERE user_id NOT IN (SELECT user_id FROM s)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT user_id, note FROM s UNION ALL SELECT user_id, coalesce(nullif(note, ''), 'Pending analysis') FROM n""")
def insert_ignore(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stored = events.where("event_id % 50 = 0").select("user_id").distinct().withColumn("note", F.lit("Pending analysis"))
    more = events.select("event_id", "user_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("note"))
    return ingest.insert_ignore(stored, more, "user_id", "event_id", defaults={"note": "Pending analysis"})


@registered("""SELECT d.doc_id, d.lang, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN 9 END, l.quality) AS quality
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def keyed_update(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 3 == 0, 9).alias("quality"))
    return ingest.keyed_update(docs, table(spark, sf_dir, "labels"), "doc_id", "quality")


@registered("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'ERROR: ' || coalesce(props->>'$.k', 'unknown')
WHEN event_type = 'signup' THEN 'DISABLED: comments are off' WHEN floor(value) = 0 THEN 'NO_COMMENTS: nothing to fetch'
ELSE printf('SUCCESS: %d comments in %d parts', floor(value)::BIGINT, (floor(value / 10) + 1)::BIGINT) END AS status FROM events) GROUP BY status""")
def status_tally(spark, sf_dir):
    n, parts = F.floor("value"), F.floor(F.col("value") / 10) + 1
    error = F.when(F.col("event_type") == "error", F.coalesce(jsonx.json_text(F.col("props"), "k"), F.lit("unknown")))
    status = metrics.comment_status(n, parts, error, F.col("event_type") == "signup")
    return metrics.status_tally(table(spark, sf_dir, "events").select(status.alias("status")), "status")


@registered("""SELECT event_id, 'ERROR: ' || coalesce(props->>'$.k', 'unknown') AS status FROM events WHERE event_type = 'error'""")
def status_failures(spark, sf_dir):
    n = F.floor("value")
    error = F.when(F.col("event_type") == "error", F.coalesce(jsonx.json_text(F.col("props"), "k"), F.lit("unknown")))
    status = metrics.comment_status(n, n, error, F.lit(False))
    rows = table(spark, sf_dir, "events").select("event_id", F.when(status.startswith("NO_COMMENTS"), "SUCCESS: none").otherwise(status).alias("status"))
    return metrics.failures(rows, "status")


# --- transcripts ---------------------------------------------------------------------------------------------------

#: Turns as lines: a turn lasts 15 seconds.
LINES_SQL = """SELECT conv_id, turn, turn * 15 AS ts_s, printf('[%02d:%02d:%02d] %s: %s', turn * 15 // 3600, turn * 15 % 3600 // 60, turn * 15 % 60, role,
       replace(replace(text, chr(13), ' '), chr(10), ' ')) AS line FROM conversations"""


def turn_rows(spark, sf_dir) -> DataFrame:
    flat = F.translate("text", "\r\n", "  ")
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), "role", (F.col("turn") * 15_000).alias("start_time"), flat.alias("text"))


def session_text(spark, sf_dir) -> DataFrame:
    return transcripts.merged_lines(turn_rows(spark, sf_dir), F.lit(0), "conv_id")


@registered(f"SELECT conv_id, string_agg(line, chr(10) ORDER BY turn) AS transcript FROM ({LINES_SQL}) GROUP BY conv_id")
def session_transcript(spark, sf_dir):
    return session_text(spark, sf_dir)


@registered(f"SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, ts_s, line FROM ({LINES_SQL})")
def transcript_lines(spark, sf_dir):
    return transcripts.transcript_lines(session_text(spark, sf_dir), "transcript", "conv_id")


SECTIONS = '{"lead-in":{"start":"00:00:15","end":"00:00:30"},"wrap_up":{"start":"00:03:00","end":"00:03:15"},"teaching_vocab_1":{"start":"00:02:30","end":"00:02:30"},"warm_up":{"start":"00:00:10"}}'
SECTIONS_SQL = "(VALUES ('lead_in', 15, 30), ('wrap_up', 180, 195), ('teaching_vocab_1', 150, 150)) s(section, a, b)"
WINDOWS_SQL = f"""SELECT conv_id, section, string_agg(line, chr(10) ORDER BY turn) AS "window" FROM ({LINES_SQL}) l, {SECTIONS_SQL}
WHERE ts_s BETWEEN greatest(0, a - 120) AND b + 120 GROUP BY conv_id, section"""


def windows(spark, sf_dir) -> DataFrame:
    sessions = session_text(spark, sf_dir)
    wanted = jsonx.sections(sessions.withColumn("sections", F.lit(SECTIONS)), "sections", "conv_id")
    return transcripts.section_windows(transcripts.transcript_lines(sessions, "transcript", "conv_id"), wanted, "conv_id")


@registered(WINDOWS_SQL)
def section_windows(spark, sf_dir):
    return windows(spark, sf_dir)


@registered("""SELECT DISTINCT conv_id, section FROM conversations, (VALUES ('warm_up'), ('homework')) s(section)""")
def missing_sections(spark, sf_dir):
    """Of four sections wanted, one has no end and one is not there at all."""
    sessions = table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("sections", F.lit(SECTIONS))
    return transcripts.missing_sections(sessions, "sections", "conv_id", ["lead_in", "wrap_up", "warm_up", "homework"])


@registered(f"""SELECT conv_id, section || '_' || tag AS key, prompt, "window" FROM ({WINDOWS_SQL}) w JOIN
(VALUES ('lead_in', 'score', 'Score the lead-in.'), ('teaching_vocab', 'score', 'Score the vocabulary.'), ('teaching_vocab', 'advice', 'Advise.')) p(family, tag, prompt)
ON regexp_replace(section, '_[0-9]+$', '') = family""")
def score_requests(spark, sf_dir):
    prompts = [("lead_in", "score", "Score the lead-in."), ("teaching_vocab", "score", "Score the vocabulary."), ("teaching_vocab", "advice", "Advise."), ("wrap_up", "score", " ")]
    return transcripts.score_requests(windows(spark, sf_dir), spark.createDataFrame(prompts, "family string, tag string, prompt string"), "conv_id")


PLAIN_TEXT = r"regexp_replace(text, '[^A-Za-z0-9 .,]', ' ', 'g')"


@registered(f"""SELECT conv_id, string_agg(printf('[%02d:%02d:%02d] %s: %s', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000, role, said), chr(10) ORDER BY ms, r, turn) AS transcript
FROM (SELECT conv_id, role, turn, (turn // 2) * 4000 + 500 AS ms, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS r, {PLAIN_TEXT} AS said FROM conversations) GROUP BY conv_id""")
def speaker_merge(spark, sf_dir):
    """Segments of each role as a literal list, parsed and merged by time; roles tie in pairs."""
    said = F.regexp_replace("text", "[^A-Za-z0-9 .,]", " ")
    ms = F.floor(F.col("turn") / 2) * 4000 + 500
    literal = F.format_string("{'speaker': '%s', 'start_time': %d, 'end_time': %d, 'text': '%s'}", F.col("role"), ms, ms + 3000, said)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "role", "turn", literal.alias("literal"))
    lists = transcripts.ordered_join(rows, "literal", ", ", ["turn"], "conv_id", "role", name="output")
    parsed = transcripts.segments(lists, "output", "conv_id", "role")
    rank = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    return transcripts.merged_lines(parsed, rank, "conv_id")


@registered("""SELECT conv_id, role, trim(replace(replace(text, chr(13), ' '), chr(10), ' ')) AS utterance, count(*) AS n
FROM conversations WHERE role IN ('user', 'assistant') GROUP BY ALL""")
def role_lines(spark, sf_dir):
    """Conversations as role-labelled text with blank lines between, parsed again."""
    labelled = F.concat(F.initcap("role"), F.lit(": "), F.translate("text", "\r\n", "  "))
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", labelled.alias("line"))
    whole = transcripts.ordered_join(lines, "line", "\n\n", ["turn"], "conv_id", name="roles")
    said = transcripts.role_lines(whole, "roles", {"user": "User:", "assistant": "Assistant:"}, "conv_id")
    return said.groupBy("conv_id", "role", "utterance").agg(F.count(F.lit(1)).alias("n"))


@registered("""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, (turn * 15)::DOUBLE AS start_s,
printf('%d:%02d:%02d', turn * 15 // 3600, turn * 15 % 3600 // 60, turn * 15 % 60) AS clock, text AS said FROM
(SELECT conv_id, turn, regexp_replace(text, '[^A-Za-z0-9 .,]', 'x', 'g') AS text FROM conversations)""")
def subtitle_lines(spark, sf_dir):
    """Conversations as subtitle XML, parsed again."""
    plain = F.regexp_replace("text", "[^A-Za-z0-9 .,]", "x")
    tag = F.format_string('<text start="%d" dur="15">%s</text>', F.col("turn") * 15, plain)
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", tag.alias("line"))
    whole = transcripts.ordered_join(lines, "line", "", ["turn"], "conv_id", name="body")
    xml = whole.select("conv_id", F.concat(F.lit("<transcript>"), "body", F.lit("</transcript>")).alias("xml"))
    rows = transcripts.subtitle_lines(xml, "xml", "conv_id")
    return rows.select("conv_id", "pos", "start_s", timefmt.span_clock(F.col("start_s")).alias("clock"), F.col("text").alias("said"))


@registered("""SELECT folder, base, max(CASE WHEN position('HV' IN name) > 0 THEN name END) AS first_role,
max(CASE WHEN position('HV' IN name) = 0 AND position('mentor' IN name) > 0 THEN name END) AS second_role FROM
(SELECT p_size AS folder, 'vid' || p_partkey AS base FROM part) v JOIN
(SELECT p_size AS folder, 'audio vid' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN ' mentor.wav' ELSE ' HV.wav' END AS name FROM part
 UNION ALL SELECT p_size, CASE WHEN p_partkey % 3 = 0 THEN 'vid' || p_partkey || ' mentor HV.mp3' ELSE 'other' || p_partkey || '.mp3' END FROM part) a USING (folder)
WHERE position(base IN name) > 0 GROUP BY folder, base HAVING first_role IS NOT NULL AND second_role IS NOT NULL""")
def name_pairing(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_size").alias("folder"), "p_partkey")
    copies = F.format_string("Bản sao của vid%d.mp4", F.col("p_partkey"))
    videos = part.select("folder", text.base_name(copies).alias("base"))
    first = F.concat(F.format_string("audio vid%d", F.col("p_partkey")), F.when(F.col("p_partkey") % 3 == 0, " mentor.wav").otherwise(" HV.wav"))
    second = F.when(F.col("p_partkey") % 3 == 0, F.format_string("vid%d mentor HV.mp3", F.col("p_partkey"))).otherwise(F.format_string("other%d.mp3", F.col("p_partkey")))
    audio = part.select("folder", first.alias("name")).union(part.select("folder", second))
    return transcripts.paired_names(videos, audio, "folder")


@registered("""SELECT 'out' AS sheet, 'C' || n_nationkey AS cell, v AS value FROM
(SELECT n_nationkey, 'B' || n_nationkey AS cell, n_name AS v FROM nation UNION ALL SELECT n_nationkey, 'D' || n_nationkey, n_regionkey::VARCHAR FROM nation) WHERE cell LIKE 'B%'""")
def cell_copy(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    cell = lambda letter: F.concat(F.lit(letter), F.col("n_nationkey").cast("string"))
    cells = nation.select(F.lit("backend").alias("sheet"), cell("B").alias("cell"), F.col("n_name").alias("value"))
    cells = cells.union(nation.select(F.lit("backend"), cell("D"), F.col("n_regionkey").cast("string")))
    mapping = nation.select(F.lit("backend").alias("from_sheet"), cell("B").alias("from_cell"), F.lit("out").alias("to_sheet"), cell("C").alias("to_cell"))
    return transcripts.cell_copy(cells, mapping)


@registered("""WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id, turn, text AS question, answer, list_distinct_ordered(x) AS concepts FROM (SELECT *, (list_filter(regexp_split_to_array(lower(trim(text || ' ' || answer)), '[ \\t\\n\\x0b\\f\\r]+'),
  lambda w: length(w) > 3 AND w NOT IN ('tại','sao','vì','khi','qua','hơn','với','của','các','đó','này')))[1:5] AS x FROM t WHERE role = 'user' AND next_role = 'assistant' AND text <> '' AND answer <> ''))
SELECT conv_id, turn, 'Create an educational illustration that explains: Câu hỏi: "' || question || '" Trả lời: "' || answer || '". Style: friendly cartoon style with expressive characters and bright colors. The image should show core concepts including '
 || array_to_string(concepts, ', ') || ' with clear visual explanation that helps understand the relationship between the question and answer.' AS prompt FROM q""".replace(
    "list_distinct_ordered(x)", "list_filter(x, lambda w, i: list_position(x, w) = i)"))
def qa_prompts(spark, sf_dir):
    """Each user turn with the assistant turn after it."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(order), "answer": F.lead("text").over(order)})
    asked = turns.where("role = 'user' AND next_role = 'assistant'")
    return asked.select("conv_id", "turn", text.image_prompt(F.col("text"), F.col("answer"), "cartoon").alias("prompt")).where("prompt IS NOT NULL")


# --- packing and merges --------------------------------------------------------------------------------------------

PARTS_SQL = """WITH RECURSIVE c AS (SELECT conv_id, turn, text, length(text) + 2 AS cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE text IS NOT NULL),
f AS (SELECT conv_id, rn, 1 AS part_no, cost AS size FROM c WHERE rn = 1
 UNION ALL SELECT c.conv_id, c.rn, CASE WHEN f.size + c.cost > 400 THEN f.part_no + 1 ELSE f.part_no END, CASE WHEN f.size + c.cost > 400 THEN c.cost ELSE f.size + c.cost END
 FROM f JOIN c ON c.conv_id = f.conv_id AND c.rn = f.rn + 1)
SELECT conv_id, part_no, count(*)::INT AS n_items, string_agg(text, chr(10) || chr(10) ORDER BY rn) AS part FROM f JOIN c USING (conv_id, rn) GROUP BY conv_id, part_no"""


@registered(PARTS_SQL)
def pack_texts(spark, sf_dir):
    return pack.packed_parts(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", most=400)


@registered(f"""WITH p AS ({PARTS_SQL}) SELECT conv_id, count(*) AS n_parts, max(part) FILTER (part_no = 1) AS comments_1, max(part) FILTER (part_no = 2) AS comments_2, max(part) FILTER (part_no = 3) AS comments_3 FROM p GROUP BY conv_id""")
def part_columns(spark, sf_dir):
    parts = pack.packed_parts(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", most=400)
    return pack.part_columns(parts, "conv_id", 3)


@registered("""WITH RECURSIVE d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS rn FROM documents), n AS (SELECT count(*) AS n, 4 * greatest(4, length(bin(count(*)))) AS rounds FROM documents),
p(merge_no, slot, r, x) AS (SELECT m, s, 0, s FROM range(1, 101) a(m), range(4) b(s)
 UNION ALL SELECT merge_no, slot, r + 1, CASE WHEN ('0x' || md5('merge|' || merge_no || '|' || (r + 1) || '|' || greatest(x, y))[1:13])::BIGINT % 2 = 1 THEN y ELSE x END
 FROM (SELECT p.*, ((('0x' || md5('merge|' || merge_no || '|' || (r + 1))[1:13])::BIGINT - x) % n + n) % n AS y FROM p, n WHERE r < rounds))
SELECT merge_no, string_agg(doc_id::VARCHAR, ', ' ORDER BY doc_id) AS ids, string_agg(text, chr(10) || '-----------' || chr(10) ORDER BY doc_id) AS text
FROM p JOIN n ON r = rounds JOIN d ON rn = x + 1 GROUP BY merge_no""")
def chunk_merge(spark, sf_dir):
    """A hundred merges of four documents, drawn from all."""
    return pack.chunk_merges(table(spark, sf_dir, "documents"), "doc_id", "text", k=4, times=100)


@registered("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders""")
def row_index(spark, sf_dir):
    return index.dense_index(table(spark, sf_dir, "orders"), F.desc("o_orderdate"), "o_orderkey").select("o_orderkey", "rn")


@registered("""SELECT o_orderkey, rn, (rn - 1) // 20 AS batch_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) WHERE rn > 100""")
def batches(spark, sf_dir):
    return index.batches(table(spark, sf_dir, "orders"), 20, "o_orderkey", after=100).select("o_orderkey", "rn", "batch_no")


@registered("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'clip' || l_partkey || '.MP3' ELSE 'line ' || l_partkey END AS said,
 row_number() OVER w AS pos FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)),
b AS (SELECT *, said IS NULL AND coalesce(lag(said IS NULL) OVER w, false) AND coalesce(lag(said IS NULL, 2) OVER w, false) AS ended FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos)),
c AS (SELECT l_orderkey, min(pos) AS cut FROM b WHERE ended GROUP BY l_orderkey)
SELECT l_orderkey, pos, said, CASE WHEN lower(said) LIKE '%.mp3%' THEN 'reference' ELSE 'synthesise' END AS route, CASE WHEN l_partkey % 5 = 0 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS speed
FROM b LEFT JOIN c USING (l_orderkey) WHERE said IS NOT NULL AND (cut IS NULL OR pos < cut)""")
def stop_on_blanks(spark, sf_dir):
    """Lines of an order as a script: every third part is blank, every seventh names a clip."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    part = F.col("l_partkey")
    said = F.when(part % 3 == 0, " \t ").when(part % 7 == 0, F.format_string("clip%d.MP3", part)).otherwise(F.format_string("line  %d?", part))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(order).cast("long").alias("pos"), text.clean_text(said).alias("said"), F.when(part % 5 != 0, 1.5).alias("speed"))
    kept = pack.until_blanks(rows.fillna({"speed": 1.0}), "l_orderkey", "pos", F.col("said").isNull())
    return kept.select("l_orderkey", "pos", "said", ingest.media_route(F.col("said")).alias("route"), "speed")


# --- scores --------------------------------------------------------------------------------------------------------

SCORES_SQL = """SELECT doc_id, quality, (doc_id * 37 % 1000) / 1000.0::DOUBLE AS child, (doc_id * 91 % 1000) / 1000.0::DOUBLE AS age,
CASE WHEN doc_id % 11 = 0 THEN 'error' ELSE 'success' END AS status FROM labels"""
LABEL_SQL = "CASE WHEN child > 0.4 OR age < 0.25 THEN 'child' ELSE 'adult' END"


def scores(spark, sf_dir) -> DataFrame:
    status = F.when(F.col("doc_id") % 11 == 0, "error").otherwise("success")
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality", (F.col("doc_id") * 37 % 1000 / 1000.0).alias("child"), (F.col("doc_id") * 91 % 1000 / 1000.0).alias("age"), status.alias("status"))
    return rows.withColumn("made", metrics.label_threshold(F.col("child"), F.col("age"), 0.4, 0.25)).select("*", "made.label", "made.confidence")


@registered(f"SELECT doc_id, {LABEL_SQL} AS label, round(CASE WHEN child > 0.4 THEN child WHEN age < 0.25 THEN age ELSE 1 - child END, 4) AS confidence FROM ({SCORES_SQL})")
def label_threshold(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "label", F.round("confidence", 4).alias("confidence"))


@registered(f"""WITH s AS (SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status <> 'success') AS errors,
count(*) FILTER (status = 'success' AND label = 'child') AS child, count(*) FILTER (status = 'success' AND label = 'adult') AS adult FROM (SELECT status, {LABEL_SQL} AS label FROM ({SCORES_SQL})))
SELECT unnest(['total', 'success', 'errors', 'child', 'adult', 'child_rate', 'adult_rate', 'success_rate']) AS metric, unnest([total::VARCHAR, success::VARCHAR, errors::VARCHAR, child::VARCHAR, adult::VARCHAR,
printf('%.2f%%', coalesce(child * 100.0 / success, 0)), printf('%.2f%%', coalesce(adult * 100.0 / success, 0)), printf('%.2f%%', coalesce(success * 100.0 / total, 0))]) AS value FROM s""")
def label_stats(spark, sf_dir):
    return metrics.label_stats(scores(spark, sf_dir))


PAIRS_SQL = """SELECT CASE l.quality WHEN 1 THEN 'good' ELSE 'bad' END AS t, CASE WHEN d.n_chars > 1000 THEN 'good' ELSE 'bad' END AS p FROM documents d JOIN labels l USING (doc_id)"""


def quality_pairs(spark, sf_dir) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("t"))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 1000, "good").otherwise("bad").alias("p")).join(labels, "doc_id")


@registered(f"SELECT t AS true_label, count(*) FILTER (p = 'good') AS good, count(*) FILTER (p = 'bad') AS bad FROM ({PAIRS_SQL}) GROUP BY t")
def pr_confusion(spark, sf_dir):
    return metrics.confusion(quality_pairs(spark, sf_dir), "t", "p", ["good", "bad"])


@registered(f"""WITH pairs AS ({PAIRS_SQL}), c AS (SELECT name, count(*) FILTER (t = name AND p = name)::DOUBLE AS tp, count(*) FILTER (p = name)::DOUBLE AS said, count(*) FILTER (t = name)::DOUBLE AS support
FROM (VALUES ('good'), ('bad'), ('odd')) n(name), pairs GROUP BY name),
r AS (SELECT name, coalesce(tp / nullif(said, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS re, support, tp FROM c),
f AS (SELECT name, pr, re, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1, support, tp FROM r)
SELECT name, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), sum(support) FROM f
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), sum(support) FROM f
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support) FROM f""")
def class_report(spark, sf_dir):
    report = metrics.class_report(quality_pairs(spark, sf_dir), "t", "p", ["good", "bad", "odd"])
    return report.select("name", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "support")


# --- text, JSON, pages ---------------------------------------------------------------------------------------------

@registered("""SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(text, '[\\x00-\\x1F\\x7F-\\x9F\\xAD]', '', 'g'), '[ \\xA0]+', ' ', 'g'), '[\\\\/*?:"<>|]', '', 'g')), '') AS cleaned FROM documents""")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@registered("""SELECT doc_id, md5(CASE WHEN length(text) > 5000 THEN left(text, 5000) || chr(10) || '[...]' ELSE text END) AS capped_md5, left(text, 100) AS preview FROM documents""")
def capped_text(spark, sf_dir):
    """Texts cut for a cell, with a marker, and their previews: the cut is the feature."""
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.capped(c, 5_000)).alias("capped_md5"), text.preview(c).alias("preview"))


#: An answer for each event: fenced or bare, an array or one object, with keys that differ, some broken.
def answers(spark, sf_dir) -> DataFrame:
    e, user, kind, k = F.col("event_id"), F.col("user_id"), F.col("event_type"), jsonx.json_text(F.col("props"), "k")
    one = F.format_string('{"user": %d, "kind": "%s", "tags": ["a", "%s"]}', user, kind, kind)
    two = F.format_string('[{"user": %d, "k": "%s"}, 5, {"kind": "%s", "note": null}]', user, k, kind)
    body = F.when(e % 3 == 0, one).when(e % 3 == 1, two).otherwise(F.format_string("{broken %d", e))
    fenced = F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nDone ```json\n{}\n```"))
    return table(spark, sf_dir, "events").select("event_id", F.when(e % 2 == 0, fenced).otherwise(body).alias("answer"))


ONE_SQL = """printf('{"user": %d, "kind": "%s", "tags": ["a", "%s"]}', user_id, event_type, event_type)"""
TWO_SQL = """printf('[{"user": %d, "k": "%s"}, 5, {"kind": "%s", "note": null}]', user_id, props->>'$.k', event_type)"""
BODY_SQL = f"CASE event_id % 3 WHEN 0 THEN {ONE_SQL} WHEN 1 THEN {TWO_SQL} ELSE printf('{{broken %d', event_id) END"


@registered(f"""SELECT event_id, {BODY_SQL} AS body, CASE WHEN event_id % 2 = 0 THEN 'Here:' || chr(10) || '```json' || chr(10) || ({BODY_SQL}) || chr(10) || '```' || chr(10) || 'Done ```json' || chr(10) || '{{}}' ELSE {BODY_SQL} END AS bare FROM events""")
def fence_json(spark, sf_dir):
    """bare: only marks at the very ends go, so that a text around the block stays."""
    rows = answers(spark, sf_dir)
    return rows.select("event_id", text.fenced_json(F.col("answer")).alias("body"), text.unfenced(F.col("answer")).alias("bare"))


@registered("""SELECT event_id, 0 AS pos, user_id::VARCHAR AS "user", event_type AS kind, '["a","' || event_type || '"]' AS tags, NULL AS k, NULL AS note FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 0, user_id::VARCHAR, NULL, NULL, props->>'$.k', NULL FROM events WHERE event_id % 3 = 1
UNION ALL SELECT event_id, 2, NULL, event_type, NULL, NULL, NULL FROM events WHERE event_id % 3 = 1""")
def answers_table(spark, sf_dir):
    return jsonx.answers_table(answers(spark, sf_dir), "answer", "event_id")


@registered("""SELECT count(*) AS n_answers, count(*) FILTER (event_id % 3 = 2) AS n_unread, sum(CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END)::BIGINT AS n_items, count(*) FILTER (event_id % 3 = 1) AS n_dropped FROM events""")
def answers_dropped(spark, sf_dir):
    return jsonx.answers_dropped(answers(spark, sf_dir), "answer")


@registered("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus || ', ' || o_orderpriority WHEN 1 THEN o_orderpriority ELSE 'no information' END AS purpose FROM orders""")
def joined_purpose(spark, sf_dir):
    """Purposes as a list, as plain text, or none."""
    key, listed = F.col("o_orderkey"), F.to_json(F.array("o_orderstatus", "o_orderpriority"))
    purpose = F.when(key % 3 == 0, listed).when(key % 3 == 1, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", jsonx.joined_purpose(purpose).alias("purpose"))


@registered("""SELECT o_orderkey, 'Post: ' || o_orderpriority || chr(10) || 'Transcript: ' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'Không có' END || chr(10) || 'Comments: ' || CASE WHEN o_orderkey % 3 = 0 THEN 'Không có' ELSE o_custkey::VARCHAR END AS prompt FROM orders""")
def content_prompts(spark, sf_dir):
    key = F.col("o_orderkey")
    transcript, comments = F.when(key % 2 == 0, F.col("o_orderstatus")), F.when(key % 3 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.content_prompt(F.col("o_orderpriority"), transcript, comments).alias("prompt"))


@registered("""WITH o AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, o_custkey AS c FROM orders)
SELECT o_orderkey, '- status: ' || s || chr(10) || '- parts:' || chr(10) || '  + ' || p || chr(10) || '  + x' AS bullets, p || ', x' AS points, '- need ' || p || chr(10) || '- more' AS needs,
CASE o_orderkey % 4 WHEN 0 THEN 'deep ' || p WHEN 1 THEN 'first ' || p WHEN 2 THEN 'plain ' || p ELSE 'no information' END AS insight, CASE WHEN o_orderkey % 2 = 0 THEN 'buyer ' || c ELSE 'no information' END AS persona FROM o""")
def bullets(spark, sf_dir):
    """Model answers about comments, written from orders and read back as fixed columns."""
    s, p, c, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey"), F.col("o_orderkey")
    insight = F.when(key % 4 == 0, F.format_string('"A_hidden_insights": {"insight": "deep %s"}', p)).when(key % 4 == 1, F.format_string('"A_hidden_insights": ["first %s", "x"]', p)).when(
        key % 4 == 2, F.format_string('"A_hidden_insights": "plain %s"', p)).otherwise('"A_other": 1')
    persona = F.when(key % 2 == 0, F.format_string('"A_persona": {"description": "buyer %d"}, ', c)).otherwise("")
    whole = F.concat(F.lit("{"), persona, F.format_string('"A_painpoints": {"one": ["%s", "x"], "two": "not a list"}, "A_needs": ["need %s", "more"], "A_sensitive": {"status": "%s", "parts": ["%s", "x"]}, ', p, p, s, p), insight, F.lit("}"))
    rows = jsonx.answer_columns(table(spark, sf_dir, "orders").select("o_orderkey", whole.alias("answer")), "answer", "A")
    return rows.select("o_orderkey", F.col("A_sensitive").alias("bullets"), F.col("A_painpoints").alias("points"), F.col("A_needs").alias("needs"), F.col("A_hidden_insights").alias("insight"), F.col("A_persona").alias("persona"))


@registered("""WITH p AS (SELECT page_id, md5(url) AS h, split_part(split_part(url, '//', 2), '/', 1) AS host FROM pages)
SELECT page_id, h[1:11] AS video, CASE WHEN page_id % 4 = 3 THEN NULL ELSE 'PL' || h[1:16] END AS playlist, CASE page_id % 3 WHEN 0 THEN 'handle' WHEN 1 THEN 'channel' ELSE 'custom' END AS ref_type,
CASE page_id % 3 WHEN 0 THEN h[1:8] WHEN 1 THEN 'UC' || h[1:22] ELSE h[3:9] END AS ref_value, CASE page_id % 3 WHEN 0 THEN h[1:8] END AS user_name FROM p""")
def url_ids(spark, sf_dir):
    """Video, playlist and channel URLs written from page URLs in their various forms, and read back."""
    h, n = F.md5("url"), F.col("page_id")
    v = F.substring(h, 1, 11)
    video = F.when(n % 4 == 0, F.concat(F.lit("@https://www.youtube.com/watch?v="), v)).when(n % 4 == 1, F.concat(F.lit("youtu.be/"), v)).when(
        n % 4 == 2, F.concat(F.lit("youtube.com/watch?t=9&v="), v)).otherwise(F.concat(F.lit("https://youtu.be/"), v, F.lit("?t=3")))
    listed = F.concat(F.lit("list=PL"), F.substring(h, 1, 16))
    playlist = F.when(n % 4 == 0, F.concat(F.lit("https://www.youtube.com/playlist?"), listed)).when(n % 4 == 1, F.concat(F.lit("m.youtube.com/watch?v=x&"), listed, F.lit("&index=2"))).when(
        n % 4 == 2, F.concat(F.lit("https%253A%252F%252Fyoutu.be%252Fx%253F"), F.replace(listed, F.lit("="), F.lit("%253D")))).otherwise(F.concat(F.lit("example.org/?"), listed))
    channel = F.when(n % 3 == 0, F.concat(F.lit("https://www.youtube.com/@"), F.substring(h, 1, 8), F.lit("/videos"))).when(n % 3 == 1, F.concat(F.lit("UC"), F.substring(h, 1, 22))).otherwise(
        F.concat(F.lit("youtube.com/c/"), F.substring(h, 3, 7)))
    ref = text.channel_ref(channel)
    return table(spark, sf_dir, "pages").select("page_id", text.video_id(video).alias("video"), text.playlist_id(playlist).alias("playlist"), ref["ref_type"].alias("ref_type"), ref["ref_value"].alias("ref_value"), text.user_name(channel).alias("user_name"))


#: A text of a page without tags, its character references decoded; the last semicolon may be missing.
SHOWN_SQL = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&quot;?', '\"', 'g'), '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"


@registered(f"""SELECT page_id, {SHOWN_SQL.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang, 'Description not available' AS description,
array_to_string(list_transform(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), lambda x: {SHOWN_SQL.format("x")}), ' | ') AS headings,
array_to_string(list_transform(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1), lambda x: {SHOWN_SQL.format("x")}), ', ') AS items,
length(list_distinct(regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1)))::INT AS n_links FROM pages""")
def page_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", html.page_fields(F.col("html")).alias("f"))
    return pages.select("page_id", "f.title", "f.lang", "f.description", F.array_join("f.headings", " | ").alias("headings"), html.list_items(F.col("f")).alias("items"), F.size("f.links").alias("n_links"))


@registered("""WITH p AS (SELECT page_id, md5(url)[1:11] AS v, page_id % 4 AS k FROM pages)
SELECT page_id, 'Fields & "more" of ' || page_id AS description, 'https://www.youtube.com/watch?v=' || v || CASE k WHEN 0 THEN '' WHEN 1 THEN ' https://www.youtube.com/watch?v=' || v ELSE ' https://www.youtube.com/watch?v=x' || page_id END AS videos,
'Team: <' || v || '>, Role: page ' || page_id || CASE WHEN k = 3 THEN ', Empty: ' ELSE '' END AS labels FROM p""")
def page_details(spark, sf_dir):
    """Descriptions, videos and labels written into the pages in the forms that pages have them in, and read back."""
    n, v = F.col("page_id"), F.substring(F.md5("url"), 1, 11)
    meta = F.when(n % 2 == 0, F.format_string("<META content='Fields &amp; &quot;more&quot; of %d' NAME=Description>", n)).otherwise(F.format_string('<meta name="description" property="x" content="Fields &#38; &#x22;more&#34; of %d"/>', n))
    frame = F.when(n % 4 == 0, F.lit("")).when(n % 4 == 1, F.concat(F.lit("<iframe src='//www.youtube.com/embed/"), v, F.lit("?rel=0'></iframe>"))).otherwise("")
    video = F.concat(F.lit("<!-- <devsite-video video-id='no'> --><DevSite-Video\nclass=x VIDEO-ID="), v, F.lit(">"), frame, F.lit("</DevSite-Video>"))
    direct = F.when(n % 4 >= 2, F.format_string('<IFRAME width=1 SRC="https://www.youtube.com/embed/x%d?start=3&amp;y=1"></IFRAME>', n)).otherwise(F.concat(F.lit('<iframe src="https://www.youtube.com/embed/'), v, F.lit('"></iframe>')))
    labels = F.concat(F.lit("<DL><dt>Team<dd>&lt;"), v, F.format_string("&gt;</dd><DT> Role </DT><dd>page\n <b>%d</b>", n), F.when(n % 4 == 3, "<dt>Empty<dd>").otherwise(""), F.lit("</DL><dd>without a term</dd>"))
    page = F.concat(F.col("html"), F.lit("<script>document.write('<dt>no</dt>')</script>"), meta, video, direct, labels)
    fields = table(spark, sf_dir, "pages").select("page_id", html.page_fields(page).alias("f"))
    return fields.select("page_id", "f.description", F.array_join("f.videos", " ").alias("videos"), F.array_join("f.labels", ", ").alias("labels"))


@registered("""SELECT doc_id, CASE WHEN text IS NULL THEN 'no text' WHEN regexp_matches(text, '(?i)(^|[^\\pL\\pN])(license|released|the)($|[^\\pL\\pN])') THEN 'keyword' ELSE 'none' END AS keyword_group FROM documents""")
def keyword_split(spark, sf_dir):
    group, _ = ingest.keyword_split(F.col("text"), ["the", "license", "released"])
    return table(spark, sf_dir, "documents").select("doc_id", group.alias("keyword_group"))


KEYWORD_SQL = "CASE WHEN text IS NULL THEN 'no text' WHEN regexp_matches(text, '(?i)(^|[^\\pL\\pN])(license|released|the)($|[^\\pL\\pN])') THEN 'keyword' ELSE 'none' END"


@registered(f"""SELECT keyword_group, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2) AS percent FROM (SELECT {KEYWORD_SQL} AS keyword_group FROM documents) GROUP BY keyword_group""")
def keyword_shares(spark, sf_dir):
    return ingest.keyword_shares(table(spark, sf_dir, "documents"), "text", ["the", "license", "released"])


#: Keywords without their text: RE2 looks at no surroundings, so each keyword takes the character after it along, and a
#: second pass gets those whose own character before the first one has taken.
STRIP_SQL = "regexp_replace({0}, '(?i)(^|[^\\pL\\pN])(license|released|the)($|[^\\pL\\pN])', '\\1\\3', 'g')"


@registered(f"""SELECT doc_id, md5(trim(regexp_replace({STRIP_SQL.format(STRIP_SQL.format('text'))}, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))) AS stripped_md5 FROM documents""")
def keyword_free_text(spark, sf_dir):
    _, stripped = ingest.keyword_split(F.col("text"), ["the", "license", "released"])
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(stripped).alias("stripped_md5"))


# --- counts, times, records ----------------------------------------------------------------------------------------

@registered("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN (o_custkey % 1000) * 10000 WHEN 1 THEN (o_custkey % 900) * 1000 WHEN 2 THEN o_custkey ELSE 0 END AS followers, o_orderkey AS views FROM orders""")
def count_text(spark, sf_dir):
    key, c = F.col("o_orderkey"), F.col("o_custkey")
    followers = F.when(key % 4 == 0, F.concat(F.format_number(c % 1000 / F.lit(100), 2), F.lit("M subscribers"))).when(key % 4 == 1, F.format_string("%dK subscribers", c % 900)).when(
        key % 4 == 2, F.format_string("%d subscribers", c)).otherwise("n/a")
    views = F.concat(F.format_number(key, 0), F.lit(" views"))
    return table(spark, sf_dir, "orders").select("o_orderkey", timefmt.short_count(followers).alias("followers"), timefmt.digits_count(views).alias("views"))


@registered("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN n % 3600 ELSE n END AS seconds, printf('%02d:%02d:%02d', n // 3600, n % 3600 // 60, n % 60) AS clock,
CASE WHEN n * 20 >= 86400 THEN (n * 20 // 86400) || CASE WHEN n * 20 // 86400 = 1 THEN ' day, ' ELSE ' days, ' END ELSE '' END || printf('%d:%02d:%02d', n * 20 % 86400 // 3600, n * 20 % 3600 // 60, n * 20 % 60) AS span
FROM (SELECT event_id, event_id * 7919 % 36000 AS n FROM events)""")
def length_secs(spark, sf_dir):
    n = F.col("event_id") * 7919 % 36_000
    hours, minutes, seconds = F.floor(n / 3600), F.floor(n % 3600 / 60), n % 60
    length = F.when(F.col("event_id") % 5 == 0, "45").when(F.col("event_id") % 5 == 1, F.format_string("%d:%02d", minutes, seconds)).otherwise(F.format_string("%d:%02d:%02d", hours, minutes, seconds))
    return table(spark, sf_dir, "events").select("event_id", timefmt.length_seconds(length).alias("seconds"), timefmt.ms_clock(n * 1000 + 999).alias("clock"), timefmt.span_clock(n * 20).alias("span"))


@registered("""SELECT event_id, strftime(CASE event_id % 6 WHEN 5 THEN DATE '2025-03-01' WHEN 0 THEN (TIMESTAMP '2025-03-01 10:00:00' - to_hours(n))::DATE WHEN 1 THEN DATE '2025-03-01' - n::INT WHEN 2 THEN DATE '2025-03-01' - 7 * n::INT
 WHEN 3 THEN DATE '2025-03-01' - 30 * n::INT ELSE DATE '2025-03-01' - 365 * n::INT END, '%Y-%m-%d') AS published FROM (SELECT event_id, event_id % 13 + 1 AS n FROM events)""")
def relative_date(spark, sf_dir):
    e = F.col("event_id")
    unit = F.get(F.array(*map(F.lit, ["hours", "days", "weeks", "months", "years", "moons"])), (e % 6).cast("int"))
    said = F.format_string("Streamed %d %s ago", e % 13 + 1, unit)
    return table(spark, sf_dir, "events").select("event_id", F.date_format(timefmt.relative_date(said, F.lit("2025-03-01 10:00:00").cast("timestamp")), "yyyy-MM-dd").alias("published"))


@registered("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, n AS seconds FROM (SELECT event_id, ts, floor(value)::BIGINT % 300 AS n FROM events) WHERE n > 60 AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'""")
def long_calls(spark, sf_dir):
    """Calls of over a minute within twenty days, lengths written as m:s."""
    n = F.floor("value").cast("long") % 300
    at = lambda day: F.lit(f"2024-01-{day} 00:00:00").cast("timestamp")
    calls = table(spark, sf_dir, "events").where(F.col("ts").between(at("05"), at("25"))).select("event_id", "ts", F.format_string("%d:%d", F.floor(n / 60), n % 60).alias("duration"))
    rows = metrics.long_calls(calls, "ts", timefmt.length_seconds(F.col("duration")))
    return rows.select("event_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "seconds")


@registered("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_calls, sum(n)::BIGINT AS seconds FROM (SELECT ts, floor(value)::BIGINT % 300 AS n FROM events) WHERE n > 60 GROUP BY day""")
def calls_per_day(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select("event_id", "ts", (F.floor("value").cast("long") % 300).alias("n"))
    days = metrics.calls_per_day(metrics.long_calls(calls, "ts", F.col("n")))
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_calls", "seconds")


@registered("""SELECT batch, '{"records":[' || string_agg('{"fields":{"key":"' || s_suppkey || '","name":"' || s_name || '","note":"' || CASE WHEN s_nationkey % 2 = 0 THEN 'None' ELSE s_nationkey::VARCHAR END || '"}}', ',' ORDER BY s_suppkey::VARCHAR) || ']}' AS payload
FROM (SELECT *, (row_number() OVER (ORDER BY s_suppkey) - 1) // 100 AS batch FROM supplier) GROUP BY batch""")
def record_payload(spark, sf_dir):
    rows = index.batches(table(spark, sf_dir, "supplier"), 100, "s_suppkey")
    named = rows.withColumn("note", F.when(F.col("s_nationkey") % 2 == 1, F.col("s_nationkey")))
    fields = ingest.coalesce_aliases(named, {"batch": ["batch_no"], "key": ["supplier_id", "s_suppkey"], "name": ["s_name"], "note": ["note"]})
    return jsonx.record_payload(fields, F.col("batch"), "key", "name", "note")


@registered("""SELECT 'id' || o_orderkey AS "Video ID", c_name AS "Author", CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE floor(o_totalprice)::BIGINT END AS "Views", CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://x/' || o_orderkey END AS "Subtitles",
strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Created", NULL::VARCHAR AS "Hashtags", 'https://www.youtube.com/watch?v=' || o_orderkey AS "Link" FROM orders JOIN customer ON o_custkey = c_custkey""")
def flatten_payload(spark, sf_dir):
    """Posts as nested payloads, flattened with defaults and put into the published layout."""
    key = F.col("o_orderkey").cast("string")
    subtitles = F.when(F.col("o_orderkey") % 3 != 0, F.array(F.struct(F.concat(F.lit("https://x/"), key).alias("url")))).otherwise(F.array().cast("array<struct<url:string>>"))
    posts = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("id"), F.struct(F.col("c_name").alias("uniqueId")).alias("author"),
        F.when(F.col("o_orderkey") % 5 != 0, F.struct(F.floor("o_totalprice").cast("long").alias("playCount"))).alias("stats"),
        F.struct(subtitles.alias("items")).alias("subtitles"), F.unix_timestamp("o_orderdate").alias("createTime"))
    flat = ingest.flatten(posts, {"id": ("id", None), "author": ("author.uniqueId", ""), "views": ("stats.playCount", 0), "subs": ("subtitles.items[0].url", ""), "created": ("createTime", 0)})
    flat = flat.withColumns({"link": text.watch_url(F.col("id")), "id": ingest.with_id_prefix(F.col("id")), "created": timefmt.epoch_text(F.col("created"))})
    return ingest.publish_layout(flat, {"id": "Video ID", "author": "Author", "views": "Views", "subs": "Subtitles", "created": "Created", "link": "Link"}, ["Video ID", "Author", "Views", "Subtitles", "Created", "Hashtags", "Link"])


@registered("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def top_orders(spark, sf_dir):
    """A top-k report."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@registered("""SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%a%' THEN 'audio' WHEN lower(p_name) LIKE '%v%' THEN 'video' END AS kind, p_brand || '_' || p_partkey || '.mp4' AS file, p_partkey::VARCHAR AS back, '[' || p_brand || ']' || chr(10) || '[' || p_type || ']' AS comment
FROM part WHERE p_size > 2 AND coalesce(p_name, '') <> ''""")
def tidy_columns(spark, sf_dir):
    part = ingest.require_columns(table(spark, sf_dir, "part"), "p_partkey", "p_name").where(ingest.present("p_name"))
    longer, _ = ingest.split_short(part, "p_size", 2)
    file = text.video_file(F.col("p_brand"), F.col("p_partkey").cast("string"))
    return longer.select("p_partkey", ingest.kind_of_name(F.col("p_name"), [("a", "audio"), ("v", "video")]).alias("kind"), file.alias("file"), ingest.id_of_file(file).alias("back"), text.comment_line(F.col("p_brand"), F.col("p_type")).alias("comment"))


@registered("""SELECT lang AS title, md5(text) AS body_md5, doc_id % 28 + 1 AS day FROM documents WHERE doc_id % 28 + 1 BETWEEN 5 AND 20""")
def review_rows(spark, sf_dir):
    """Nested reviews, one page per source and language day, exploded and kept by date."""
    day = F.col("doc_id") % 28 + 1
    review = F.struct(F.struct(F.col("lang").alias("title"), F.col("text").alias("body"), F.format_string("2025-01-%02d", day).alias("createdDate")).alias("attributes"))
    pages = table(spark, sf_dir, "documents").select(F.array(review).alias("data"))
    rows = jsonx.reviews(pages).where(F.to_date("created").between("2025-01-05", "2025-01-20"))
    return rows.select("title", F.md5("body").alias("body_md5"), F.day(F.to_date("created")).cast("long").alias("day"))


@registered("""SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS name FROM orders""")
def time_names(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("orders_"), timefmt.time_name(F.col("o_orderdate"))).alias("name"))


# --- sources and sinks: written to the shared folder and read back ---------------------------------------------------

@registered("""SELECT s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey, s_acctbal FROM supplier""")
def sheet_scan(spark, sf_dir):
    """A sheet as CSV with header; a number column is wanted as text."""
    path = shared.scratch(spark, "sheet")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    rows.write.option("header", True).csv(path)
    return readers.sheet(spark, path, rows.schema, ("s_nationkey",))


@registered("""SELECT event_id AS call_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS called_at, '0' || user_id AS phone, event_type AS agent FROM events""")
def call_log_scan(spark, sf_dir):
    """The headerless call log, written from events."""
    path = shared.scratch(spark, "calls")
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("0"), F.col("user_id").cast("string")), "event_type", F.lit("1:00"), F.lit("https://x/a.mp3"))
    events.write.option("header", False).csv(path)
    return readers.call_log(spark, path).select("call_id", F.date_format("called_at", "yyyy-MM-dd HH:mm:ss").alias("called_at"), "phone", "agent")


@registered("""SELECT page_id AS n, url FROM pages""")
def url_list_scan(spark, sf_dir):
    """A list of numbered URLs with other lines between, written as ordered lines and read back."""
    path = shared.scratch(spark, "urls")
    line = F.concat(F.col("page_id").cast("string"), F.lit(". "), "url", F.lit("\nsee above"))
    writers.write_lines(table(spark, sf_dir, "pages").select("page_id", line.alias("line")), path, "line", "page_id")
    return readers.numbered_lines(spark, path)


@registered("""SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT -c_custkey, 'again ' || c_name, NULL FROM customer WHERE c_acctbal < 0""")
def table_versions(spark, sf_dir):
    """A table written as one version, and a later one that rows have been added to, columns matched by name."""
    root = shared.scratch(spark, "versions")
    customer = table(spark, sf_dir, "customer")
    writers.write_version(customer.select("c_custkey", "c_name", "c_nationkey"), root, "customer", "1")
    more = customer.where("c_acctbal < 0").select(F.concat(F.lit("again "), "c_name").alias("c_name"), (-F.col("c_custkey")).alias("c_custkey"))
    writers.write_version(ingest.union_by_name(writers.read_version(spark, root, "customer", "1"), more), root, "customer", "2")
    return writers.read_version(spark, root, "customer")


@registered("""SELECT row_number() OVER (ORDER BY fresh, s_suppkey) AS "STT", s_suppkey, s_name FROM (SELECT 0 AS fresh, s_suppkey, s_name FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT 1, s_suppkey, s_name FROM supplier WHERE s_nationkey >= 12)""")
def appended_rows(spark, sf_dir):
    """Rows appended to a stored table and numbered on, in two goes; what is stored stays as it is."""
    root, rows = shared.scratch(spark, "append"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    runs.write_numbered(rows.where("s_nationkey < 12").select("s_suppkey", "s_name"), root, "suppliers", "1", "s_suppkey")
    fresh = rows.where("s_nationkey >= 12")
    middle = fresh.agg(F.expr("percentile(s_suppkey, 0.5)")).first()[0] or 0
    runs.append_numbered(fresh.where(F.col("s_suppkey") <= middle).select("s_name", "s_suppkey"), root, "suppliers", "2", "s_suppkey")
    runs.append_numbered(fresh.where(F.col("s_suppkey") > middle).select("s_suppkey", "s_name"), root, "suppliers", "3", "s_suppkey")
    return runs.read_numbered(spark, root, "suppliers")


@registered("""SELECT CASE WHEN o_totalprice > 100000 THEN 'large' ELSE 'small' END AS label, o_orderkey, o_totalprice FROM orders""")
def label_outputs(spark, sf_dir):
    """Several named outputs out of one source, read back and put together."""
    root, label = shared.scratch(spark, "outputs"), F.when(F.col("o_totalprice") > 100_000, "large").otherwise("small")
    orders = table(spark, sf_dir, "orders").select(label.alias("label"), "o_orderkey", "o_totalprice")
    writers.write_outputs(orders, {name: lambda df, name=name: df.where(F.col("label") == name) for name in ("large", "small")}, root, "1")
    return writers.read_version(spark, root, "large").unionByName(writers.read_version(spark, root, "small"))


@registered("""SELECT p_brand AS final_label, p_partkey, p_retailprice FROM part""")
def label_folders(spark, sf_dir):
    """Rows routed into a folder for each label, read back with the label from the folder's name."""
    path = shared.scratch(spark, "labels")
    writers.write_by_label(table(spark, sf_dir, "part").select(F.col("p_brand").alias("final_label"), "p_partkey", "p_retailprice"), path)
    return spark.read.schema("p_partkey long, p_retailprice double, final_label string").parquet(path)


@registered("""WITH c AS (SELECT DISTINCT table_name, column_name, ordinal_position, data_type FROM information_schema.columns WHERE table_name IN ('customer', 'documents', 'labels')),
p AS (SELECT 'customer' AS table_name, * FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM customer) ON COLUMNS(*) INTO NAME column_name VALUE present)
UNION ALL SELECT 'documents', * FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM documents) ON COLUMNS(*) INTO NAME column_name VALUE present)
UNION ALL SELECT 'labels', * FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM labels) ON COLUMNS(*) INTO NAME column_name VALUE present)),
n AS (SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'labels', count(*) FROM labels)
SELECT table_name, column_name, ordinal_position::BIGINT AS position, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS type, n AS rows, present
FROM c JOIN p USING (table_name, column_name) JOIN n USING (table_name)""")
def catalog_profile(spark, sf_dir):
    """Tables found in the session's catalog, their columns and types, and how many rows have each."""
    prefix = "profiled_"
    for name in ("customer", "documents", "labels"):
        table(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
    found = [name for name in readers.table_list(spark) if name.startswith(prefix)]
    parts = [readers.column_profile(spark, name).withColumn("table_name", F.lit(name.removeprefix(prefix))) for name in found]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    for name in found:
        spark.catalog.dropTempView(name)
    return rows.select("table_name", "column_name", "position", "type", "rows", "present")


@registered("""SELECT event_type AS label, sum(octet_length(encode(coalesce(props, ''))) + 1)::BIGINT AS bytes FROM events GROUP BY event_type""")
def media_listing(spark, sf_dir):
    """Files in label folders, listed by suffix with their lengths alone; other files of the folder are not listed."""
    path, events = shared.scratch(spark, "media"), table(spark, sf_dir, "events")
    events.select(F.coalesce("props", F.lit("")).alias("value"), F.col("event_type").alias("label")).write.partitionBy("label").text(path)
    events.select("event_id", F.col("event_type").alias("label")).write.mode("append").partitionBy("label").json(path)
    files = readers.media_files(spark, path, "*.txt")
    return files.groupBy(F.regexp_extract("path", "/label=([^/]*)/", 1).alias("label")).agg(F.sum("length").alias("bytes"))


def relational_options(spark: SparkSession) -> dict[str, str]:
    """Where `relation_scan` keeps its table: the database that spark.rowloom.jdbc.url (.user, .password, .driver) names,
    which executors must reach. Where that is unset, one in memory if all of Spark is one process, as in tests; executors
    elsewhere don't see that, so there it is a table of Spark's catalog, without a url."""
    given = {key: spark.conf.get(f"spark.rowloom.jdbc.{key}", "") for key in ("url", "user", "password", "driver")}
    name = f"R_{uuid.uuid4().hex[:16].upper()}"
    if not given["url"]:
        if not (master := spark.sparkContext.master).startswith("local") or master.startswith("local-cluster"):
            return {"dbtable": name}
        given = {"url": "jdbc:derby:memory:rowloom;create=true", "user": "APP", "password": "x", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    options = readers.jdbc_options(given["url"], name, given["user"], given["password"])
    return options | ({"driver": given["driver"]} if given["driver"] else {})


@registered("""SELECT c_custkey AS id, CASE WHEN c_nationkey < 8 THEN 3 WHEN c_nationkey < 20 THEN 1000 * c_custkey END AS split_key, c_acctbal AS amount FROM customer""")
def relation_scan(spark, sf_dir):
    """A relational table read in even ranges of a key of which a third of the rows have one value and some have none."""
    options = relational_options(spark)
    key = F.when(F.col("c_nationkey") < 8, F.lit(3).cast("long")).when(F.col("c_nationkey") < 20, 1000 * F.col("c_custkey").cast("long"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("ID"), key.alias("SPLIT_KEY"), F.col("c_acctbal").alias("AMOUNT"))
    if "url" in options:
        rows.write.format("jdbc").options(**options).save()
    else:
        path = shared.scratch(spark, "relation")
        writers.write_by_key(rows, path, "SPLIT_KEY")
        spark.read.schema(rows.schema).parquet(path).createOrReplaceTempView(options["dbtable"])
    found = readers.relation_in_ranges(spark, "SPLIT_KEY", 8, **options)
    if "url" not in options:
        spark.catalog.dropTempView(options["dbtable"])
    return found.select(F.col("ID").alias("id"), F.col("SPLIT_KEY").alias("split_key"), F.col("AMOUNT").alias("amount"))


@registered("""SELECT n.n_name AS nation, c.c_custkey AS id, c.c_name AS name FROM customer c JOIN nation n ON c_nationkey = n_nationkey""")
def page_records(spark, sf_dir):
    """Response pages, one JSON document for each nation's customers, and their records exploded."""
    path = shared.scratch(spark, "pages")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("nation"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 64).alias("page"))
    writers.write_json(named.groupBy("nation", "page").agg(F.collect_list(F.struct("nation", "id", "name")).alias("records")).select("records"), path)
    return readers.record_pages(spark, path, "struct<nation:string,id:long,name:string>", multi_line=False)


@registered("""WITH k AS (SELECT event_id, hash_no, event_type FROM (SELECT event_id, event_id % 5 AS hash_no, event_type FROM events))
SELECT event_id, CASE WHEN hash_no = 4 THEN 'late' ELSE event_type END AS rating, CASE hash_no WHEN 4 THEN 9 ELSE hash_no END AS version FROM k""")
def keyed_runs(spark, sf_dir):
    """Ten small upserts into a keyed table, the last of which replaces a fifth of the rows; runs are merged on the way."""
    root, events = shared.scratch(spark, "keyed"), table(spark, sf_dir, "events")
    for number in range(10):
        part = events.where(F.col("event_id") % 5 == (number if number < 5 else 4 if number == 9 else -1))
        rating = F.lit("late") if number == 9 else F.col("event_type")
        rows = part.select("event_id", rating.alias("rating"), F.lit(number).cast("long").alias("version"))
        runs.upsert(rows, root, "ratings", str(number), "event_id", "version", fan_in=3)
    return runs.read_latest(spark, root, "ratings", "event_id", "version")


@registered(f"""WITH old AS ({OLD}) SELECT event_id, rating FROM old
UNION ALL SELECT e.event_id, e.event_type FROM events e LEFT JOIN old USING (event_id) WHERE old.event_id IS NULL OR old.rating IS DISTINCT FROM e.event_type""")
def feed_state(spark, sf_dir):
    """Two landed snapshots through the streaming feed: all that its state holds after both."""
    root, events = shared.scratch(spark, "feed"), table(spark, sf_dir, "events")
    landed, schema = f"{root}/landed", "event_id long, rating string, snapshot_at long"
    shots = [old_ratings(events), events.select("event_id", F.col("event_type").alias("rating"))]
    for number, shot in enumerate(shots):
        shot.select(F.col("event_id").cast("long").alias("event_id"), "rating", F.lit(number).cast("long").alias("snapshot_at")).write.mode("append").parquet(landed)
        feed.run_feed(spark, landed, schema, root, f"{root}/checkpoint", "event_id", "rating", lambda changed, batch: None, files_per_batch=10_000)
    return feed.feed_log(spark, root).select("event_id", "rating")


@registered("""SELECT event_id, event_type AS rating FROM events""")
def feed_latest(spark, sf_dir):
    """The same two snapshots into a state without history: the latest rating of every record."""
    root, events = shared.scratch(spark, "feed"), table(spark, sf_dir, "events")
    landed, schema = f"{root}/landed", "event_id long, rating string, snapshot_at long"
    shots = [old_ratings(events), events.select("event_id", F.col("event_type").alias("rating"))]
    for number, shot in enumerate(shots):
        shot.select(F.col("event_id").cast("long").alias("event_id"), "rating", F.lit(number).cast("long").alias("snapshot_at")).write.mode("append").parquet(landed)
        feed.run_feed(spark, landed, schema, root, f"{root}/checkpoint", "event_id", "rating", lambda changed, batch: None, files_per_batch=10_000, history=False)
    return feed.feed_state(spark, root, "event_id").select("event_id", "rating")

"""Transcripts: segments, merged lines, section windows and scoring requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.jsonx import sections
from rowloom.functions.timefmt import line_seconds, ms_clock

#: Shares of a folder's names that are indexed apart.
SHARES = 16

_SEGMENT = "struct<speaker:string,start_time:bigint,end_time:bigint,text:string>"


def ordered_join(df: DataFrame, line: str, separator: str, order: list[str], *keys: str, name: str = "transcript") -> DataFrame:
    """The lines of each key in order, joined. `order` has to settle ties. A key's lines meet in one task: they are one
    text in the result."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(line).alias("_line")))).alias("_lines"))
    return rows.select(*keys, F.array_join(F.transform("_lines", lambda x: x["_line"]), separator).alias(name))


def segments(df: DataFrame, column: str, *ids: str, mode: str = "strict") -> DataFrame:
    """The id columns, pos, speaker, start_time, end_time, text of segments written as a literal list.

    strict: quotes are swapped first, so an apostrophe inside a text makes its segment unreadable and it is dropped.
    lenient: single, double and mixed quotes are read. Braces inside a text break its segment in either mode."""
    found = F.regexp_extract_all(F.col(column), F.lit(r"\{[^{}]*\}"), F.lit(0))
    rows = df.select(*ids, F.posexplode(found).alias("pos", "_raw"))
    source = F.replace("_raw", F.lit("'"), F.lit('"')) if mode == "strict" else F.col("_raw")
    options = {"allowSingleQuotes": "false"} if mode == "strict" else {"allowSingleQuotes": "true"}
    rows = rows.withColumn("s", F.from_json(source, _SEGMENT, {**options, "mode": "PERMISSIVE"}))
    return rows.where(F.col("s.start_time").isNotNull() & F.col("s.text").isNotNull()).select(*ids, "pos", "s.*")


def merged_lines(df: DataFrame, rank: Column, session: str, by: str = "ms", template: str = "[%s] %s: %s") -> DataFrame:
    """One transcript per session out of the segments of all its speakers: lines `[HH:MM:SS] role: text` by start time.
    by: `ms`, or `s` to order by whole seconds; rank settles ties between roles, pos those within one.
    df: session, role, pos, start_time, text."""
    at = F.col("start_time") if by == "ms" else F.floor(F.col("start_time") / 1000)
    line = F.format_string(template, ms_clock(F.col("start_time")), F.col("role"), F.col("text"))
    rows = df.select(session, at.alias("_at"), rank.alias("_rank"), F.col("pos").alias("_pos"), line.alias("line"))
    return ordered_join(rows, "line", "\n", ["_at", "_rank", "_pos"], session)


def transcript_lines(df: DataFrame, column: str, *ids: str, strict_hours: bool = True) -> DataFrame:
    """The id columns, pos, ts_s, line of each line with a stamp; other lines are dropped."""
    rows = df.select(*ids, F.posexplode(F.split(F.btrim(F.col(column), F.lit(" \t\r\n")), "\n")).alias("pos", "line"))
    return rows.withColumn("ts_s", line_seconds(F.col("line"), strict_hours)).where("ts_s IS NOT NULL").select(*ids, "pos", "ts_s", "line")


def section_windows(lines: DataFrame, wanted: DataFrame, session: str, pad: int = 120, bin_seconds: int = 600, block: int = 4_096) -> DataFrame:
    """(session, section, window): the lines within `pad` seconds of each section, both ends included, in order of pos.

    lines: session, pos, ts_s, line. wanted: session, section, start_s, end_s; a section without start or end, or
    without a line, gives no row. Lines are dealt by session and time bin and sections copied to the bins that they cover, as
    far as the session has lines; so a session's lines are spread, however many it has. Lines are first joined within
    blocks of positions, then the blocks."""
    last = lines.groupBy(F.col(session).alias("_last_of")).agg(F.max("ts_s").alias("_last"), F.min("ts_s").alias("_start"))
    spans = wanted.where("start_s IS NOT NULL AND end_s IS NOT NULL").select(
        F.col(session).alias("_session"), "section", F.greatest(F.lit(0), F.col("start_s") - pad).alias("_from"), (F.col("end_s") + pad).alias("_to"))
    spans = spans.join(last, F.col("_session") == F.col("_last_of")).withColumns({"_a": F.greatest("_from", "_start"), "_b": F.least("_to", "_last")}).where("_a <= _b")
    bin_of = lambda c: F.floor(F.col(c) / bin_seconds)
    covered = spans.select("_session", "section", "_from", "_to", F.explode(F.sequence(bin_of("_a"), bin_of("_b"))).alias("_bin"))
    same = (lines[session] == covered["_session"]) & (bin_of("ts_s") == F.col("_bin")) & F.col("ts_s").between(F.col("_from"), F.col("_to"))
    found = lines.join(covered, same).select(session, "section", "pos", "line", F.floor(F.col("pos") / block).alias("_block"))
    parts = ordered_join(found, "line", "\n", ["pos"], session, "section", "_block", name="_part")
    return ordered_join(parts, "_part", "\n", ["_block"], session, "section", name="window")


def missing_sections(df: DataFrame, column: str, session: str, names: list[str]) -> DataFrame:
    """(session, section) of named sections that a session's JSON lacks or gives without start or end."""
    have = sections(df, column, session).where(~F.col("missing")).select(session, "section")
    return df.select(session, F.explode(F.array(*map(F.lit, names))).alias("section")).join(have, [session, "section"], "left_anti")


def score_requests(windows: DataFrame, prompts: DataFrame, session: str) -> DataFrame:
    """Each window with the prompts of its family: session, key, prompt, window. A section belongs to the family that is
    its name without a final number; blank prompts and windows are left out. prompts: family, tag, prompt."""
    family = F.regexp_replace("section", r"_\d+$", "")
    asked = prompts.where(F.trim(F.coalesce("prompt", F.lit(""))) != "").select("family", "tag", "prompt")
    rows = windows.where(F.trim("window") != "").withColumn("family", family).join(asked, "family")
    return rows.select(session, F.concat_ws("_", "section", "tag").alias("key"), "prompt", "window")


def paired_names(videos: DataFrame, audio: DataFrame, folder: str, gram: int = 8) -> DataFrame:
    """(folder, base, first_role, second_role): for each video of a folder the audio files whose name contains its base
    name, one for each role, both needed. HV is tested before mentor; the last name of a role counts.

    videos: folder, base. audio: folder, name. Names without a role are left out at once. A base is looked up by one of its
    pieces, as long as the greatest power of two that the base and `gram` allow: the one that fewest bases of its folder
    have, so a piece that many names share is asked for by few. Names are indexed by their pieces of the lengths that
    their folder's bases ask for (so an index has as many rows as names have characters, times one to four), and what
    is found is verified. All joins are by sorting: nothing of a size that grows with the tables is broadcast. An empty
    base pairs nothing, nor does anything in a null folder."""
    size = F.lit(1)
    for n in range(1, gram.bit_length()):
        size = F.when(F.length("base") >= 2**n, F.lit(2**n)).otherwise(size)
    wanted = videos.select(folder, "base").where(F.col(folder).isNotNull() & (F.col("base") != "")).distinct().withColumn("_size", size)
    starts = lambda text: F.explode(F.sequence(F.lit(1), F.length(text) - F.col("_size") + 1))
    piece = lambda text: F.substring(F.col(text), F.col("_at"), F.col("_size"))
    asked = wanted.select(folder, "base", "_size", starts("base").alias("_at")).select(folder, "base", piece("base").alias("_piece")).distinct()
    shared = asked.groupBy(folder, "_piece").agg(F.count(F.lit(1)).alias("_n")).hint("merge")
    keys = asked.join(shared, [folder, "_piece"]).groupBy(F.col(folder).alias("_of"), "base").agg(F.min(F.struct("_n", "_piece"))["_piece"].alias("_key"))

    # a folder may have most of the names: its lengths are dealt out with the shares of its names
    sizes = wanted.groupBy(folder).agg(F.collect_set("_size").alias("_sizes")).select(F.col(folder).alias("_of"), "_sizes", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("_share"))
    heard = audio.select(F.col(folder).alias("_in"), "name").where(F.col("name").contains("HV") | F.col("name").contains("mentor")).distinct()
    heard = heard.withColumn("_share", F.pmod(F.xxhash64("name"), F.lit(SHARES)).cast("int"))
    heard = heard.join(sizes.hint("merge"), (F.col("_in") == F.col("_of")) & (heard["_share"] == sizes["_share"])).select("_in", "name", F.explode("_sizes").alias("_size"))
    index = heard.where(F.length("name") >= F.col("_size")).select("_in", "name", "_size", starts("name").alias("_at")).select("_in", "name", piece("name").alias("_piece"))
    found = index.join(keys.hint("merge"), (F.col("_in") == F.col("_of")) & (F.col("_piece") == F.col("_key"))).where(F.col("name").contains(F.col("base")))
    role = F.when(F.col("name").contains("HV"), "first").when(F.col("name").contains("mentor"), "second")
    rows = found.withColumn("_role", role).groupBy(F.col("_of").alias(folder), "base").agg(
        F.max(F.when(F.col("_role") == "first", F.col("name"))).alias("first_role"), F.max(F.when(F.col("_role") == "second", F.col("name"))).alias("second_role"))
    return rows.where("first_role IS NOT NULL AND second_role IS NOT NULL")


def role_lines(df: DataFrame, column: str, prefixes: dict[str, str], *ids: str) -> DataFrame:
    """The id columns, pos, role, utterance of role-labelled lines; blank lines and unknown labels are dropped.
    prefixes: role -> label, matched at the very start of a line."""
    rows = df.select(*ids, F.posexplode(F.split(F.col(column), "\n")).alias("pos", "line"))
    role, said = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for name, label in prefixes.items():
        role = role.when(F.col("line").startswith(label), name)
        said = said.when(F.col("line").startswith(label), F.trim(F.substring("line", len(label) + 1, 2**31 - 1)))
    return rows.select(*ids, "pos", role.alias("role"), said.alias("utterance")).where("role IS NOT NULL")


def cell_copy(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Cells moved by an address map: (sheet, cell, value) of the targets. mapping: from_sheet, from_cell, to_sheet,
    to_cell."""
    joined = mapping.join(cells, (F.col("from_sheet") == F.col("sheet")) & (F.col("from_cell") == F.col("cell")))
    return joined.select(F.col("to_sheet").alias("sheet"), F.col("to_cell").alias("cell"), "value")


def subtitle_lines(df: DataFrame, column: str, *ids: str) -> DataFrame:
    """The id columns, pos, start_s, text of subtitle XML; a malformed document gives no row, a line without start
    starts at 0."""
    from_xml = F.from_xml(F.col(column), "text array<struct<_start:string,_dur:string,_VALUE:string>>")
    rows = df.select(*ids, F.posexplode(from_xml["text"]).alias("pos", "t"))
    return rows.select(*ids, "pos", F.coalesce(F.col("t._start").try_cast("double"), F.lit(0.0)).alias("start_s"), F.coalesce("t._VALUE", F.lit("")).alias("text"))

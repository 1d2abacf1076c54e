"""JSON kept in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.sources.shared import scratch

NO_INFORMATION = "no information"
_MAP = "map<string,string>"


def path_of(*keys: str) -> str:
    """A JSON path; keys with dots, # or blanks are quoted."""
    return "$" + "".join(f".{k}" if k.isidentifier() else f"['{k}']" for k in keys)


def json_text(c: Column, *keys: str) -> Column:
    """The value under nested keys, as text."""
    return F.get_json_object(c, path_of(*keys))


def json_has_key(c: Column, key: str) -> Column:
    """Whether an object has a top-level key, a null under it included, or an array the key among its strings. False
    for malformed text and null."""
    as_array = F.from_json(F.when(c.rlike(r"^\s*\["), c), "array<string>")
    return F.coalesce(F.array_contains(F.json_object_keys(c), key), F.array_contains(as_array, key), F.lit(False))


def is_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def _is_array(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?s)^\s*\["), F.lit(False))


def _is_object(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?s)^\s*\{"), F.lit(False))


def bullets(c: Column) -> Column:
    """An object as lines: `- key: value`, and for a list its items below as `  + item`. Other text as it is."""

    def line(e: Column) -> Column:
        items = F.transform(F.from_json(e["value"], "array<string>"), lambda x: F.concat(F.lit("\n  + "), x))
        listed = F.concat(F.lit("- "), e["key"], F.lit(":"), F.array_join(items, ""))
        return F.when(_is_array(e["value"]), listed).otherwise(F.concat(F.lit("- "), e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))))

    made = F.array_join(F.transform(F.map_entries(F.from_json(c, _MAP)), line), "\n")
    return F.when(_is_object(c), made).otherwise(c)


def listed_values(c: Column) -> Column:
    """The items of all lists of an object, comma-separated; values that are no lists don't count. Other text as is."""
    lists = F.transform(F.map_values(F.from_json(c, _MAP)), lambda v: F.when(_is_array(v), F.from_json(v, "array<string>")).otherwise(F.array().cast("array<string>")))
    return F.when(_is_object(c), F.array_join(F.flatten(lists), ", ")).otherwise(c)


def needs(c: Column) -> Column:
    """A list as bullets, an object as `bullets`, other text as it is."""
    items = F.transform(F.from_json(F.when(_is_array(c), c), "array<string>"), lambda x: F.concat(F.lit("- "), x))
    return F.when(_is_array(c), F.array_join(items, "\n")).otherwise(bullets(c))


def insight(c: Column, default: str = NO_INFORMATION) -> Column:
    """Of an object insight, else insights; of a list the first item; of text the text; else the default."""
    of_object = F.coalesce(json_text(c, "insight"), json_text(c, "insights"))
    of_list = F.get(F.from_json(F.when(_is_array(c), c), "array<string>"), F.lit(0))
    return F.coalesce(F.when(_is_object(c), of_object).when(_is_array(c), of_list).otherwise(c), F.lit(default))


def answer_columns(df: DataFrame, answer: str, prefix: str = "AI_comments") -> DataFrame:
    """The fixed columns of a model's answer about comments: persona, pain points, needs, sensitive points, insight."""
    part = lambda name: json_text(F.col(answer), f"{prefix}_{name}")
    return df.withColumns({
        f"{prefix}_persona": F.coalesce(json_text(F.col(answer), f"{prefix}_persona", "description"), F.lit(NO_INFORMATION)),
        f"{prefix}_painpoints": F.coalesce(listed_values(part("painpoints")), F.lit("")),
        f"{prefix}_needs": F.coalesce(needs(part("needs")), F.lit("")),
        f"{prefix}_sensitive": F.coalesce(bullets(part("sensitive")), F.lit("")),
        f"{prefix}_hidden_insights": insight(part("hidden_insights")),
    })


def joined_purpose(c: Column, default: str = NO_INFORMATION) -> Column:
    """A list joined by commas, other text as it is, the default without any."""
    items = F.array_join(F.from_json(F.when(_is_array(c), c), "array<string>"), ", ")
    return F.coalesce(F.when(_is_array(c), items).otherwise(c), F.lit(default))


def _bodies(df: DataFrame, answer: str, *ids: str) -> DataFrame:
    """The id columns and _valid: an answer's first fenced block, or the whole text, where that is JSON. Block and check are
    columns of their own, so that neither is worked out again for each place that asks for them."""
    from rowloom.functions.text import fenced_json

    rows = df.select(*ids, F.trim(fenced_json(F.col(answer))).alias("_body"))
    return rows.select(*ids, F.when(is_json(F.col("_body")), F.col("_body")).alias("_valid"))


def _items(valid: Column) -> Column:
    """The items of an array, or the one object; null for other values."""
    return F.when(_is_array(valid), F.from_json(valid, "array<string>")).when(_is_object(valid), F.array(valid))


def answer_items(df: DataFrame, answer: str, *ids: str) -> DataFrame:
    """One row per object of a model's answer: the id columns, pos, item (JSON text). The answer is the first fenced
    block or the whole text, an array of objects or one object; what is neither gives no row."""
    rows = _bodies(df, answer, *ids).select(*ids, F.posexplode(_items(F.col("_valid"))).alias("pos", "item"))
    return rows.where(_is_object(F.col("item")) & is_json(F.col("item")))


def answers_dropped(df: DataFrame, answer: str) -> DataFrame:
    """One row (n_answers, n_unread, n_items, n_dropped): answers, those that are no JSON object or array, items of the
    others, and those of them that are no object."""
    kept = F.size(F.filter("items", lambda item: _is_object(item) & is_json(item)))
    rows = _bodies(df, answer).select(_items(F.col("_valid")).alias("items")).select("items", F.coalesce(F.size("items"), F.lit(0)).alias("n"), F.coalesce(kept, F.lit(0)).alias("kept"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    unread = F.col("items").isNull()
    return rows.agg(F.count(F.lit(1)).alias("n_answers"), F.count_if(unread).alias("n_unread"), total(F.when(~unread, F.col("n"))).alias("n_items"), total(F.when(~unread, F.col("n") - F.col("kept"))).alias("n_dropped"))


def answers_table(df: DataFrame, answer: str, *ids: str, keys: list[str] | None = None, most_columns: int = 500) -> DataFrame:
    """answer_items with a text column for each of the keys; a key that an item lacks is null. Without keys, for each one
    that occurs, in order of first appearance; more than most_columns of them is an error.

    Without keys, the parsed items are written once to the shared folder; keys are gathered from there, by an aggregation
    that combines on the map side, and the columns are read from there, so that no answer is parsed twice."""
    items = answer_items(df, answer, *ids).select(*ids, "pos", F.from_json("item", _MAP).alias("fields"))
    if keys is None:
        path = scratch(df.sparkSession, "answers")
        items.write.parquet(path)
        items = df.sparkSession.read.schema(items.schema).parquet(path)
        rows = (
            items.select(*ids, "pos", F.posexplode(F.map_keys("fields")).alias("n", "key"))
            .groupBy("key").agg(F.min(F.struct(*ids, "pos", "n")).alias("first"))
            .orderBy("first").limit(most_columns + 1).collect()
        )
        if len(rows) > most_columns:
            raise ValueError(f"more than {most_columns} keys")
        keys = [row["key"] for row in rows]
    return items.select(*ids, "pos", *(F.element_at("fields", key).alias(key) for key in keys))


def sections(df: DataFrame, column: str, *ids: str) -> DataFrame:
    """Section JSON to rows: the id columns, section, start_s, end_s, explain, missing. Hyphens of names become
    underscores; start and end may be stamps or seconds; a section without either has missing set."""
    from rowloom.functions.timefmt import stamp_seconds

    parsed = F.from_json(F.col(column), "map<string,struct<start:string,end:string,extracted_transcription:string,explain:string>>")
    rows = df.select(*ids, F.explode(parsed).alias("section", "v"))
    seconds = lambda c: F.when(c.contains(":"), stamp_seconds(c)).otherwise(c.try_cast("bigint"))
    rows = rows.select(*ids, F.replace("section", F.lit("-"), F.lit("_")).alias("section"), seconds(F.col("v.start")).alias("start_s"), seconds(F.col("v.end")).alias("end_s"),
                       F.col("v.extracted_transcription").alias("extracted"), F.col("v.explain").alias("explain"))
    return rows.withColumn("missing", F.col("start_s").isNull() | F.col("end_s").isNull())


def reviews(df: DataFrame, column: str = "data") -> DataFrame:
    """Nested reviews to (title, body, created)."""
    return df.select(F.explode(column).alias("r")).select(
        F.col("r.attributes.title").alias("title"), F.col("r.attributes.body").alias("body"), F.col("r.attributes.createdDate").alias("created"))


def record_payload(df: DataFrame, batch: Column, *columns: str, null_text: str | None = "None") -> DataFrame:
    """(batch, records): JSON payloads `{"records":[{"fields":{...}}]}` of the rows of a batch, every value as text.
    null_text: what stands for null; None leaves such fields out. A batch is bounded by its number's width."""
    value = lambda c: F.col(c).cast("string") if null_text is None else F.coalesce(F.col(c).cast("string"), F.lit(null_text))
    record = F.struct(F.struct(*(value(c).alias(c) for c in columns)).alias("fields"))
    rows = df.groupBy(batch.alias("batch")).agg(F.sort_array(F.collect_list(record)).alias("records"))
    return rows.select("batch", F.to_json(F.struct("records")).alias("payload"))

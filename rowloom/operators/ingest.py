"""Incremental intake of records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.index import first_by


def new_keys(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key, as text, is not stored. A null key is new."""
    known = stored.select(F.col(key).cast("string").alias("_known")).distinct()
    return df.join(known, df[key].cast("string") == known["_known"], "left_anti")


def incremental_first(df: DataFrame, stored: DataFrame, key: str, *order: str) -> DataFrame:
    """Of rows with a key that is not stored, the first per key."""
    return first_by(new_keys(df, stored, key), key, *order)


def insert_ignore(stored: DataFrame, df: DataFrame, key: str, *order: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """Stored rows and the first new row of each key that is not stored; null or empty values take their defaults."""
    fresh = incremental_first(df, stored, key, *order)
    for name, text in (defaults or {}).items():
        fresh = fresh.withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(text)))
    return stored.unionByName(fresh.select(*stored.columns))


def keyed_update(df: DataFrame, values: DataFrame, key: str, column: str, overwrite: bool = False) -> DataFrame:
    """df with the column set from values by key; without overwrite only where it has none yet. A column that df lacks
    is added. values holds one row per key."""
    given = values.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
    joined = df.join(given, df[key] == given["_key"], "left")
    old = df[column] if column in df.columns else F.lit(None)
    new = F.coalesce(F.col("_value"), old) if overwrite else F.coalesce(old, F.col("_value"))
    kept = [df[c] for c in df.columns if c != column]
    return joined.select(*kept, new.alias(column))


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def publish_layout(df: DataFrame, renames: dict[str, str], order: list[str]) -> DataFrame:
    """Columns renamed and in the published order; those that df lacks are null."""
    out = df.withColumnsRenamed(renames)
    return out.select(*(F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in order))


def flatten(df: DataFrame, fields: dict[str, tuple[str, object]]) -> DataFrame:
    """A nested payload as flat columns. fields: name -> (path, default); a path may end in [0]. The default stands for
    an absent and for a null value alike, as a parsed payload can't tell them apart; None sets none."""

    def one(path: str) -> Column:
        if "[0]" in path:
            array, _, rest = path.partition("[0]")
            item = F.get(F.col(array), F.lit(0))
            return item[rest.lstrip(".")] if rest else item
        return F.col(path)

    return df.select(*((one(path) if default is None else F.coalesce(one(path), F.lit(default))).alias(name) for name, (path, default) in fields.items()))


def with_id_prefix(c: Column, prefix: str = "id") -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def without_id_prefix(c: Column, prefix: str = "id") -> Column:
    """Without the prefix; where a text starts with it, every occurrence goes."""
    return F.when(c.startswith(prefix), F.replace(c, F.lit(prefix), F.lit(""))).otherwise(c)


def id_of_file(name: Column) -> Column:
    """What stands between the first underscore and the next dot or underscore."""
    return F.split_part(F.split_part(name, F.lit("_"), F.lit(2)), F.lit("."), F.lit(1))


def present(*columns: str) -> Column:
    """All of the columns are neither null nor empty."""
    made = F.lit(True)
    for c in columns:
        made = made & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return made


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def coalesce_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Standard names from the aliases that df has, the first non-null of them; none at all is an error."""
    out = []
    for name, options in aliases.items():
        have = [F.col(o) for o in options if o in df.columns]
        if not have:
            raise ValueError(f"none of {options} for {name}")
        out.append(F.coalesce(*have).alias(name))
    return df.select(*out)


def split_short(df: DataFrame, duration: str, least: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(longer rows, rows of at most `least`); a null duration is in neither."""
    return df.where(F.col(duration) > least), df.where(F.col(duration) <= least)


def kind_of_name(name: Column, rules: list[tuple[str, str]]) -> Column:
    """The value of the first rule whose word is in the name, upper and lower case alike; null without one."""
    made = F.when(F.lit(False), F.lit(None).cast("string"))
    for word, kind in rules:
        made = made.when(F.lower(name).contains(word.lower()), kind)
    return made


def media_route(text: Column) -> Column:
    """`reference` for text that names an .mp3 or .wav file, else `synthesise`."""
    return F.when(F.lower(text).rlike(r"\.(mp3|wav)"), "reference").otherwise("synthesise")


def keyword_split(c: Column, keywords: list[str]) -> tuple[Column, Column]:
    """(`keyword`, `none` or `no text`; the text without the keywords, white space collapsed). Keywords are plain text,
    found as whole words; of two that begin alike the longer one is tried first. Without any, no text has one."""
    words = "|".join(map(re.escape, sorted(filter(None, keywords), key=lambda k: (-len(k), k)))) or "$.^"
    any_of = r"(?iu)(?<![\p{L}\p{N}])(?:" + words + r")(?![\p{L}\p{N}])"
    group = F.when(c.isNull(), "no text").when(c.rlike(any_of), "keyword").otherwise("none")
    return group, F.trim(F.regexp_replace(F.regexp_replace(c, any_of, ""), r"\s+", " "))


def keyword_shares(df: DataFrame, column: str, keywords: list[str]) -> DataFrame:
    """(keyword_group, n, percent) of the groups of keyword_split: percent of all rows, to two places."""
    counts = df.groupBy(keyword_split(F.col(column), keywords)[0].alias("keyword_group")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # three rows at most
    return counts.select("keyword_group", "n", F.round(F.col("n") * 100.0 / total, 2).alias("percent"))

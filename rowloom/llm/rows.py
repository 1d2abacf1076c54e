"""Names of rows, and reaching few rows of a table without moving the others."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.tables import written

#: Bits of the filter that spares rows a shuffle: BITS_PER_KEY for each key, in words of 64, MOST_WORDS at most (a table of
#: some 40 MB). So up to MOST_WORDS * 64 / BITS_PER_KEY = 5.6 million keys about one in fifty other rows passes; with more keys
#: there is no filter, and rows are shuffled to meet the keys, which costs their shuffle once.
BITS_PER_KEY, MOST_WORDS = 12, 1 << 20


@dataclass(frozen=True)
class Filter:
    """word, bits: a table that is broadcast; None where there are too many keys for one: then every row passes."""

    table: DataFrame | None
    words: int


def located(docs: DataFrame) -> DataFrame:
    """docs, as a scan of files: each row then has a place (see `place`) that is the same however often it is read. Other
    frames than plain scans are written to the shared folder first."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    plain = "Relation" in node.nodeName() and not docs.isStreaming and _has_rows(docs)
    return docs if plain else written(docs, "located")


def _has_rows(docs: DataFrame) -> bool:
    """Whether the source numbers its rows; where it does not, the analysis says so."""
    try:
        return bool(docs.select(_metadata(docs)["row_index"]).columns)
    except AnalysisException:
        return False


def _metadata(docs: DataFrame) -> Column:
    return docs.metadataColumn("_metadata")


def place(docs: DataFrame) -> Column:
    """Where a row of located docs lies: its file and its number there. It names the row, and its content can be read
    again from there."""
    at = _metadata(docs)
    return F.struct(at["file_path"].alias("file"), at["row_index"].alias("row"))


def row_key(docs: DataFrame) -> Column:
    """The place of a row of located docs in 16 bytes."""
    at = _metadata(docs)
    return F.unhex(F.md5(F.concat_ws("#", at["file_path"], at["row_index"].cast("string"))))


def new_name(label: str) -> str:
    """A column name that no table has."""
    return f"_{label}_{uuid.uuid4().hex}"


def words_for(keys: int) -> int:
    """How many words a filter of so many keys has; 0: none."""
    words = 1 << max(0, (max(1, keys * BITS_PER_KEY // 64) - 1).bit_length())
    return words if words <= MOST_WORDS else 0


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """Four bits of a word, of another hash."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, at).bitwiseAND(F.lit(63)).cast("int"))
    return bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12)).bitwiseOR(bit(18))


def filter_of(keys: DataFrame, key: str) -> Filter:
    """A filter that all the keys (a table that is read twice) pass, of a size that suits their number; it is written, as all
    its users must see the same."""
    words = words_for(keys.count())
    if not words:
        return Filter(None, 0)
    rows = keys.select(_word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("bits"))
    return Filter(written(rows.groupBy("word").agg(F.bit_or("bits").alias("bits")), "filter"), words)


def passing(rows: DataFrame, key: str, found: Filter, others: bool = False) -> DataFrame:
    """The rows that a filter lets through: those with one of its keys and few more, or the others. Nothing is shuffled:
    the filter's table, of at most MOST_WORDS rows, is broadcast."""
    if found.table is None:
        return rows.where(F.lit(not others))
    mask = _mask(rows[key])
    hit = (found.table["word"] == _word(rows[key], found.words)) & (found.table["bits"].bitwiseAND(mask) == mask)
    return rows.join(F.broadcast(found.table), hit, "left_anti" if others else "left_semi")


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """rows without those whose key is among `gone` (a table of keys that is read twice). Only the rows that pass the
    filter of the keys are shuffled to find out."""
    found = filter_of(gone, key)
    if found.table is None:
        return rows.join(gone, key, "left_anti")
    return passing(rows, key, found, others=True).unionByName(passing(rows, key, found).join(gone, key, "left_anti"))

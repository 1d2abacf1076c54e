"""Sources. Every reader takes an explicit schema; a source that can't be read is an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALL_LOG = "call_id LONG, called_at TIMESTAMP, phone STRING, agent STRING, duration STRING, audio_url STRING"


def jdbc_options(url: str, table: str, user: str, password: str, partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 16) -> dict[str, str]:
    """Options of a relational scan; with a partition column it is split into ranges read side by side."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": "10000"}
    if partition_column:
        if not bounds:
            raise ValueError("a partition column needs bounds")
        options |= {"partitionColumn": partition_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def relation(spark: SparkSession, **options: str) -> DataFrame:
    """A table or query of the database that `url` names, or without one of Spark's own catalog."""
    if "url" not in options:
        return spark.sql(f"SELECT * FROM {options['dbtable']}")
    return spark.read.format("jdbc").options(**options).load()


def table_list(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def table_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """(column, type) of a table; an unknown table is an error."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]


def table_preview(spark: SparkSession, table: str, rows: int = 10) -> DataFrame:
    return spark.table(table).limit(rows)


def column_profile(spark: SparkSession, table: str) -> DataFrame:
    """column_name, position (from 1), type, rows, present (not null) of every column of a table, counted in one scan."""
    columns = table_columns(spark, table)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count(F.col("`" + name.replace("`", "``") + "`")).alias(f"present_{i}") for i, (name, _) in enumerate(columns)]]
    each = [F.struct(F.lit(name).alias("column_name"), F.lit(i + 1).cast("long").alias("position"), F.lit(kind).alias("type"), "rows", F.col(f"present_{i}").alias("present")) for i, (name, kind) in enumerate(columns)]
    return spark.table(table).agg(*counts).select(F.inline(F.array(*each)))


def sheet(spark: SparkSession, path: str, schema: T.StructType | str, text_columns: tuple[str, ...] = ()) -> DataFrame:
    """A sheet kept as CSV with header, or as Parquet; text_columns stay text whatever they look like."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.schema(schema).parquet(path)
        return df.withColumns({c: F.col(c).cast("string") for c in text_columns}) if text_columns else df
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = T.StructType([T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType) for f in wanted])
    return spark.read.schema(wanted).option("header", True).option("enforceSchema", False).csv(path)


def call_log(spark: SparkSession, path: str) -> DataFrame:
    """The headerless call log."""
    return spark.read.schema(CALL_LOG).option("header", False).csv(path)


def record_pages(spark: SparkSession, path: str, item: T.DataType | str, array: str = "records", multi_line: bool = True) -> DataFrame:
    """Items of landed response pages out of their `records`, `items`, `itemList` or `data` array: one JSON document per
    file, or without multi_line one per line, which large files can be split by."""
    kind = item if isinstance(item, str) else item.simpleString()
    pages = spark.read.schema(f"`{array}` array<{kind}>").option("multiLine", multi_line).json(path)
    return pages.select(F.explode(array).alias("item")).select("item.*")


def media_files(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """path, length, modified of media files, their content unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, url) of lines `N. url`; other lines are dropped."""
    lines = spark.read.text(path)
    return lines.where(F.col("value").rlike(r"^\d+\. ")).select(
        F.regexp_extract("value", r"^(\d+)\. (.*)$", 1).cast("long").alias("n"), F.trim(F.regexp_extract("value", r"^(\d+)\. (.*)$", 2)).alias("url"))


def key_ranges(spark: SparkSession, column: str, partitions: int = 16, **options: str) -> list[str]:
    """Conditions on a whole-number key that split a relational table into some `partitions` scans of about the same number of
    rows, every row in one: the source itself counts its keys in 256 ranges of equal width and then, where a range holds more
    than a quarter of a partition's rows, in ranges within. So gaps and skew are seen, and a value that many rows share
    stands alone. Rows without a key get a scan of their own. A table without rows is one scan."""
    table = options["dbtable"]

    def rows(sql: str) -> list:
        return relation(spark, **(options | {"dbtable": f"({sql}) counted"})).collect()

    low, high, n, nulls = rows(f"SELECT MIN({column}) AS a, MAX({column}) AS b, COUNT({column}) AS n, COUNT(*) - COUNT({column}) AS m FROM {table}")[0]
    absent = [f"{column} IS NULL"] if nulls else []
    if not n:
        return absent or ["1 = 1"]
    if low != int(low) or high != int(high) or isinstance(low, (bool, float)):
        raise ValueError(f"{column} holds no whole numbers")

    def counted(start: int, end: int) -> list[tuple[int, int]]:
        """(first key, rows) of ranges between start and end, the latter not included."""
        width = max(1, -(-(end - start) // 256))
        place = f"FLOOR(({column} - ({start})) / {width})" if "url" in options else f"(CAST({column} AS DECIMAL(20, 0)) - ({start})) DIV {width}"
        found = rows(f"SELECT b, COUNT(*) AS n FROM (SELECT {place} AS b FROM {table} WHERE {column} >= {start} AND {column} < {end}) r GROUP BY b")
        out = []
        for b, m in sorted((int(b), int(m)) for b, m in found):
            first = start + b * width
            out += counted(first, min(end, first + width)) if width > 1 and m * 4 * partitions > n else [(first, m)]
        return out

    bounds, held = [], 0
    for first, m in counted(int(low), int(high) + 1):
        if held and (held + m) * partitions > n:
            bounds.append(first)
            held = 0
        held += m
    cuts = [None, *bounds, None]
    ranges = [" AND ".join([f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)) or f"{column} IS NOT NULL" for a, b in zip(cuts, cuts[1:])]
    return ranges + absent


def relation_in_ranges(spark: SparkSession, column: str, partitions: int = 16, **options: str) -> DataFrame:
    """A relational scan split by key_ranges. A table of Spark's catalog is scanned once for each range, so it should be stored
    by its key (writers.write_by_key): then a scan skips what lies outside its range."""
    ranges = key_ranges(spark, column, partitions, **options)
    if "url" not in options:
        found = relation(spark, **options)
        return reduce(DataFrame.unionAll, [found.where(condition) for condition in ranges])
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=ranges, properties=rest)

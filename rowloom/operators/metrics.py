"""Labels out of scores, and how good they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_threshold(child: Column, age: Column, child_over: float = 0.5, age_under: float = 0.3) -> Column:
    """struct(label, confidence): child where its probability is over the threshold, else where the normalised age is
    under its own (the age then stands as confidence), else adult."""
    return (
        F.when(child > child_over, F.struct(F.lit("child").alias("label"), child.alias("confidence")))
        .when(age < age_under, F.struct(F.lit("child").alias("label"), age.alias("confidence")))
        .otherwise(F.struct(F.lit("adult").alias("label"), (1 - child).alias("confidence")))
    )


def label_stats(df: DataFrame, label: str = "label", status: str = "status") -> DataFrame:
    """(metric, value): counts and rates as text; rates of no rows are 0.00%."""
    good = F.col(status) == "success"
    one = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(good).alias("success"), F.count_if(~good).alias("errors"),
        F.count_if(good & (F.col(label) == "child")).alias("child"), F.count_if(good & (F.col(label) == "adult")).alias("adult"))
    rate = lambda a, b: F.format_string("%.2f%%", F.coalesce(F.try_divide(F.col(a) * 100.0, F.col(b)), F.lit(0.0)))
    rows = F.array(*(F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in [
        *((n, F.col(n).cast("string")) for n in ("total", "success", "errors", "child", "adult")),
        ("child_rate", rate("child", "success")), ("adult_rate", rate("adult", "success")), ("success_rate", rate("success", "total"))]))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def confusion(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    """One row per true class: a count for each predicted class."""
    counts = df.groupBy(truth).agg(*(F.count_if(F.col(predicted) == c).alias(c) for c in classes))
    return counts.where(F.col(truth).isin(classes)).withColumnRenamed(truth, "true_label")


def class_report(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    """(name, precision, recall, f1, support) per class, then accuracy, macro and weighted averages; divisions by zero
    are 0. One pass over df; the rest works on one row per class."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    names = df.sparkSession.createDataFrame([(c,) for c in classes], "name string")
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    each = pairs.select("t", "p", "n", F.explode(F.array_distinct(F.array("t", "p"))).alias("name"))
    tall = names.join(each, "name", "left")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("double")
    by = tall.groupBy("name").agg(
        count((F.col("t") == F.col("name")) & (F.col("p") == F.col("name"))).alias("tp"), count(F.col("p") == F.col("name")).alias("said"), count(F.col("t") == F.col("name")).alias("support"))
    by = by.withColumn("precision", ratio(F.col("tp"), F.col("said"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    by = by.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    shown = ["precision", "recall", "f1"]
    total = F.sum("support")
    acc = by.agg(ratio(F.sum("tp"), total).alias("a"), total.alias("s")).select(F.lit("accuracy").alias("name"), *(F.col("a").alias(c) for c in shown), F.col("s").alias("support"))
    macro = by.agg(*(F.avg(c).alias(c) for c in shown), total.alias("support")).withColumn("name", F.lit("macro avg"))
    weighted = by.agg(*(ratio(F.sum(F.col(c) * F.col("support")), total).alias(c) for c in shown), total.alias("support")).withColumn("name", F.lit("weighted avg"))
    columns = ["name", *shown, "support"]
    return by.select(*columns).unionByName(acc.select(*columns)).unionByName(macro.select(*columns)).unionByName(weighted.select(*columns))


def status_tally(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def failures(df: DataFrame, status: str, good: str = "SUCCESS") -> DataFrame:
    """The rows whose status does not begin with `good`, a null one among them."""
    return df.where(~F.coalesce(F.col(status).startswith(good), F.lit(False)))


def comment_status(n: Column, parts: Column, error: Column, disabled: Column) -> Column:
    """The outcome of gathering a post's comments, as a status line."""
    return (
        F.when(error.isNotNull(), F.concat(F.lit("ERROR: "), error))
        .when(disabled, F.lit("DISABLED: comments are off"))
        .when(n == 0, F.lit("NO_COMMENTS: nothing to fetch"))
        .otherwise(F.format_string("SUCCESS: %d comments in %d parts", n, parts))
    )


def long_calls(df: DataFrame, called_at: str, seconds: Column, over: int = 60) -> DataFrame:
    """Calls of more than `over` seconds with their day."""
    return df.withColumn("seconds", seconds).where(F.col("seconds") > over).withColumn("day", F.to_date(called_at))


def calls_per_day(calls: DataFrame) -> DataFrame:
    """(day, n_calls, seconds) of long_calls."""
    return calls.groupBy("day").agg(F.count(F.lit(1)).alias("n_calls"), F.sum("seconds").alias("seconds"))

"""Row numbers, running values and as-of joins over long orders, without bringing a whole key into one task.

A key's rows are cut into spans of its order. Each span is worked on by itself; one row a span carries what comes before.
A span is so wide that about ROWS rows fall into one: numbers without gaps (span=DENSE) are cut as they are, any others by
their count and range, which one aggregate over them tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS = 1 << 16
#: For orders that number rows: 1, 2, 3 and so on, or nearly so.
DENSE = ROWS


def fitting_span(df: DataFrame, *places: str) -> float:
    """A width of spans that ROWS rows of df fall into on average, by the columns that hold their places."""
    facts = df.agg(F.count(F.lit(1)), *[f(c) for c in places for f in (F.min, F.max)]).first()
    known = [x for x in facts[1:] if x is not None]
    return max((max(known) - min(known) + 1) * ROWS / facts[0], 1) if known else 1


def _span(at: str, span: float) -> Column:
    return F.floor(F.col(at) / F.lit(span)).cast("bigint")


def number_rows(df: DataFrame, by: list[str], at: str, name: str, span: float | None = None) -> DataFrame:
    """Adds the row's number from 1 within `by` in the order of the number `at`, which no two rows of a key share."""
    cut = df.withColumn("_span", _span(at, span or fitting_span(df, at)))
    counts = cut.groupBy(*by, "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(*by, "_span").orderBy(at))
    return cut.withColumn("_local", local).join(starts, [*by, "_span"]).withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint")).drop("_span", "_start", "_local")


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, take: list[str], span: float | None = None) -> DataFrame:
    """Left rows with the `take` columns of the right row of the same key that is last at or before them; null if none.

    Right rows of a key have different places; with equal ones the largest in `take` counts.
    """
    kept = F.struct(*[F.col(c) for c in left.columns])
    found = F.struct(F.col(right_at).cast("bigint").alias("_at"), *[F.col(c) for c in take])
    width = span or fitting_span(left.select(F.col(left_at).alias("_at")).union(right.select(right_at)), "_at")
    rows = left.select(*by, F.col(left_at).cast("bigint").alias("_at"), kept.alias("_left")).unionByName(
        right.select(*by, F.col(right_at).cast("bigint").alias("_at"), found.alias("_right")), allowMissingColumns=True
    ).withColumn("_span", _span("_at", width))
    last = rows.groupBy(*by, "_span").agg(F.max("_right").alias("_last"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*by, "_span", F.max("_last").over(before).alias("_carried"))
    upto = Window.partitionBy(*by, "_span").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.withColumn("_here", F.max("_right").over(upto)).where(F.col("_left").isNotNull())
    joined = here.join(carried, [*by, "_span"], "left").withColumn("_best", F.coalesce("_here", "_carried"))
    return joined.select("_left.*", *[F.col(f"_best.{c}").alias(c) for c in take])


def fill_forward(df: DataFrame, by: list[str], at: str, value: str, name: str, span: float | None = None) -> DataFrame:
    """Adds the last value that isn't null at or before each row of its key."""
    known = df.where(F.col(value).isNotNull()).select(*by, F.col(at).alias("_known_at"), F.col(value).alias(name))
    return asof_backward(df, known, by, at, "_known_at", [name], span)


def running_total(df: DataFrame, by: list[str], at: str, value: Column, name: str, span: float | None = None) -> DataFrame:
    """Adds the sum of value over the rows of the key up to and with this one, in the order of `at`."""
    cut = df.withColumn("_value", value).withColumn("_span", _span(at, span or fitting_span(df, at)))
    sums = cut.groupBy(*by, "_span").agg(F.sum("_value").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    upto = Window.partitionBy(*by, "_span").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut.withColumn("_local", F.sum("_value").over(upto)).join(starts, [*by, "_span"]).withColumn(name, F.col("_start") + F.col("_local")).drop("_value", "_span", "_start", "_local")

"""Algebra of transaction-id sets as DataFrames of intervals (keys..., lo, hi), both ends included.

A set is canonical when its intervals neither overlap nor touch. Every function takes sets in any form and returns
canonical ones. `keys` are the columns that tell sets apart, the source's uuid among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.ordered import asof_backward
from ledgerline.sources.scratch import stored

KEYS = ("source_uuid",)
#: Numbers are first merged in spans of this many, so that a source with most of the rows is spread over many tasks.
SPAN = 1 << 16
#: A set of at most so many intervals is broadcast to find its members.
FEW = 512
#: The grammar of an entry. Numbers have no sign and no leading zero.
UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
NUMBER = "[1-9][0-9]*"
SOURCE, RANGE = rf"^(?i){UUID}\z", rf"^{NUMBER}(-{NUMBER})?\z"
#: What an entry may have around it.
BLANKS = " \t\n\x0b\f\r"


def normalize(df: DataFrame, keys: tuple[str, ...] = KEYS, span: int = SPAN) -> DataFrame:
    """Joins intervals that overlap or touch: within spans of numbers first, then the islands that remain.

    Islands that an interval of an earlier span reaches are told by one row a span, which carries how far those reach, and
    numbered by counts a span, so that no source is ordered as a whole.
    """
    part = [*keys, "_span"]
    rows = df.select(*keys, F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi")).withColumn("_span", F.floor(F.col("lo") / span))
    in_order = Window.partitionBy(*part).orderBy("lo", "hi")
    upto, earlier = in_order.rowsBetween(Window.unboundedPreceding, 0), in_order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("hi").over(earlier)
    begins = F.when(reach.isNull() | (F.col("lo") > reach + 1), 1).otherwise(0)
    near = rows.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(upto)).groupBy(*part, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    near = stored(near.select(*part, "lo", "hi"), "interval-islands")  # looked at more than once below

    over_spans = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    reached = near.groupBy(*part).agg(F.max("hi").alias("_hi")).select(*part, F.max("_hi").over(over_spans).alias("_reach"))
    # The islands of a span lie apart, so only what earlier spans reach can join one to what comes before it.
    told = near.join(reached, part).withColumn("_begins", F.when(F.col("_reach").isNull() | (F.col("lo") > F.col("_reach") + 1), 1).otherwise(0))
    starts = told.groupBy(*part).agg(F.sum("_begins").alias("_n")).select(*part, F.coalesce(F.sum("_n").over(over_spans), F.lit(0)).alias("_start"))
    numbered = told.join(starts, part).withColumn("_island", F.col("_start") + F.sum("_begins").over(upto))
    return numbered.groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(*keys, "lo", "hi")


def from_points(df: DataFrame, number: str = "gno", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The set of single transaction ids."""
    return normalize(df.select(*keys, F.col(number).alias("lo"), F.col(number).alias("hi")), keys)


#: Where a stretch lies, by how many intervals of two sets are open.
ONLY_A, BOTH = "in_a > 0 AND in_b = 0", "in_a > 0 AND in_b > 0"


def _swept(a: DataFrame, b: DataFrame, keys: tuple[str, ...], keep: str) -> DataFrame:
    """Boundaries of both sets in order, with how many intervals of each are open; keeps the stretches where `keep` holds.
    Stretches may touch."""
    zero, one = F.lit(0), F.lit(1)
    marks = None
    for side, da, db in ((a, one, zero), (b, zero, one)):
        for at, sign in (("lo", 1), ("hi", -1)):
            point = F.col("lo") if at == "lo" else F.col("hi") + 1
            rows = side.select(*keys, point.cast("bigint").alias("point"), (da * sign).alias("da"), (db * sign).alias("db"))
            marks = rows if marks is None else marks.unionByName(rows)
    marks = marks.groupBy(*keys, "point").agg(F.sum("da").alias("da"), F.sum("db").alias("db")).withColumn("_span", F.floor(F.col("point") / SPAN))
    marks = stored(marks, "interval-marks")
    spans = marks.groupBy(*keys, "_span").agg(F.sum("da").alias("_da"), F.sum("db").alias("_db"), F.min("point").alias("_first"))
    over_spans = Window.partitionBy(*keys).orderBy("_span")
    before = over_spans.rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(*keys, "_span", F.coalesce(F.sum("_da").over(before), F.lit(0)).alias("_a"), F.coalesce(F.sum("_db").over(before), F.lit(0)).alias("_b"), F.lead("_first").over(over_spans).alias("_after"))
    in_order = Window.partitionBy(*keys, "_span").orderBy("point")
    open_ = in_order.rowsBetween(Window.unboundedPreceding, 0)
    local = marks.withColumns({"_ina": F.sum("da").over(open_), "_inb": F.sum("db").over(open_), "_then": F.lead("point").over(in_order)})
    swept = local.join(carried, [*keys, "_span"]).select(*keys, "point", (F.col("_ina") + F.col("_a")).alias("in_a"), (F.col("_inb") + F.col("_b")).alias("in_b"), F.coalesce("_then", "_after").alias("_next"))
    return swept.where(F.expr(keep) & F.col("_next").isNotNull()).select(*keys, F.col("point").alias("lo"), (F.col("_next") - 1).alias("hi"))


def union(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return normalize(a.select(*keys, "lo", "hi").unionByName(b.select(*keys, "lo", "hi")), keys)


def subtract(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return normalize(_swept(a, b, keys, ONLY_A), keys)


def intersect(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return normalize(_swept(a, b, keys, BOTH), keys)


def count_points(a: DataFrame) -> DataFrame:
    """One row: how many transaction ids the canonical set holds; 0 for the empty set."""
    return a.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0)).cast("bigint").alias("n"))


def is_subset(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row, `yes`: whether b holds all of a."""
    return _swept(a, b, keys, ONLY_A).agg((F.count(F.lit(1)) == 0).alias("yes"))


def is_disjoint(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return _swept(a, b, keys, BOTH).agg((F.count(F.lit(1)) == 0).alias("yes"))


def is_equal(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Each holds all of the other."""
    return _swept(a, b, keys, "(in_a > 0) <> (in_b > 0)").agg((F.count(F.lit(1)) == 0).alias("yes"))


def _holding(rows: DataFrame, intervals: DataFrame, number: str, keys: tuple[str, ...]) -> DataFrame:
    """Adds _hi, the end of the last interval that begins at or before the row's number."""
    lowered = rows.withColumn("_uuid", F.lower(F.col(keys[0])))
    sets = intervals.select(F.lower(F.col(keys[0])).alias("_uuid"), *keys[1:], F.col("lo").alias("_at"), F.col("hi").alias("_hi"))
    return asof_backward(lowered, sets, by=["_uuid", *keys[1:]], left_at=number, right_at="_at", take=["_hi"], span=SPAN).drop("_uuid")


def _semi(rows: DataFrame, intervals: DataFrame, number: str, keys: tuple[str, ...], inside: bool) -> DataFrame:
    """The rows in the set, or those that aren't. A set of FEW intervals, as most are, is broadcast as it is: its size is
    checked first. Beyond that each row looks up the last interval before it, once they are joined."""
    sets = stored(intervals.select(*keys, F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi")), "interval-set")
    if sets.count() <= FEW:
        held = F.broadcast(sets.select(*[F.lower(F.col(k)).alias(f"_{k}") if k == keys[0] else F.col(k).alias(f"_{k}") for k in keys], F.col("lo").alias("_lo"), F.col("hi").alias("_hi")))
        same = (F.lower(F.col(keys[0])) == F.col(f"_{keys[0]}")) & F.col(number).between(F.col("_lo"), F.col("_hi"))
        for k in keys[1:]:
            same = same & (F.col(k) == F.col(f"_{k}"))
        return rows.join(held, same, "left_semi" if inside else "left_anti")
    found = _holding(rows, normalize(sets, keys), number, keys)
    holds = F.coalesce(F.col("_hi") >= F.col(number), F.lit(False))
    return found.where(holds if inside else ~holds).drop("_hi")


def members(rows: DataFrame, intervals: DataFrame, number: str = "gno", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows whose transaction id is in the set; the uuid in any case, both ends included."""
    return _semi(rows, intervals, number, keys, inside=True)


def non_members(rows: DataFrame, intervals: DataFrame, number: str = "gno", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows whose transaction id isn't in the set."""
    return _semi(rows, intervals, number, keys, inside=False)


def uncovered(ranges: DataFrame, intervals: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The ranges (lo, hi) that the set doesn't hold whole: as its intervals never touch, one of them must hold a range."""
    return _holding(ranges, normalize(intervals, keys), "lo", keys).where(F.coalesce(F.col("_hi") < F.col("hi"), F.lit(True))).drop("_hi")


def entry_fault(entry: Column) -> Column:
    """Null for a well-formed entry, else why it is refused; never holds any of the entry's text."""
    # Each part is matched by itself: a pattern over all parts would go as deep as there are parts.
    parts = F.split(F.trim(entry, F.lit(BLANKS)), ":")
    malformed = (F.size(parts) < 2) | ~F.regexp_like(F.get(parts, F.lit(0)), F.lit(SOURCE)) | F.exists(_ranges(parts), lambda r: ~F.regexp_like(r, F.lit(RANGE)))
    ends = F.transform(F.filter(_ranges(parts), lambda r: F.contains(r, F.lit("-"))), lambda r: F.split(r, "-"))
    descending = F.exists(ends, lambda e: e[0].cast("decimal(38,0)") > e[1].cast("decimal(38,0)"))
    return F.when(malformed, F.lit("malformed_entry")).when(descending, F.lit("descending_interval"))


def _ranges(parts: Column) -> Column:
    """What follows the source in the parts of an entry."""
    return F.slice(parts, F.lit(2), F.size(parts))


def set_fault(text: Column) -> Column:
    """Null for a well-formed set, else the first fault among its comma-parted entries; the empty text is the empty set."""
    faults = F.filter(F.transform(F.split(text, ",", -1), entry_fault), lambda x: x.isNotNull())
    return F.when(F.length(F.regexp_replace(text, r"\s", "")) == 0, F.lit(None).cast("string")).otherwise(F.get(faults, F.lit(0)))


def parse(df: DataFrame, text: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., source_uuid, lo, hi) of set texts; white space counts only at the ends of entries. A malformed text fails the query."""
    fault = set_fault(F.col(text))
    whole = F.when(fault.isNotNull(), F.raise_error(F.lit("malformed transaction-id set")).cast("string")).otherwise(F.regexp_replace(F.col(text), r"\s+", ""))
    entries = df.select(*keys, F.explode(F.filter(F.split(whole, ","), lambda x: F.length(x) > 0)).alias("_entry"))
    parted = entries.select(*keys, F.lower(F.substring_index("_entry", ":", 1)).alias("source_uuid"), _ranges(F.split("_entry", ":")).alias("_ranges"))
    ranges = parted.select(*keys, "source_uuid", F.explode("_ranges").alias("_range"))
    ends = F.split("_range", "-")
    return normalize(ranges.select(*keys, "source_uuid", ends[0].cast("bigint").alias("lo"), F.element_at(ends, -1).cast("bigint").alias("hi")), (*keys, "source_uuid"))


def render_sources(intervals: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys..., gtid_set): each source's canonical text, its intervals in order."""
    part = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")))
    listed = normalize(intervals, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", part.alias("text")))).alias("_parts"))
    return listed.select(*keys, F.concat_ws(":", F.col(keys[-1]), F.array_join(F.transform("_parts", lambda p: p["text"]), ":")).alias("gtid_set"))


def render(intervals: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., gtid_set): each set's canonical text, its sources in order; one row with the empty text for the empty set."""
    each = render_sources(intervals, (*keys, "source_uuid"))
    text = F.array_join(F.array_sort(F.collect_list("gtid_set")), ",").alias("gtid_set")
    return each.groupBy(*keys).agg(text) if keys else each.agg(text)

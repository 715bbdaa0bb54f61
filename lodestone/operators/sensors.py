"""Sensor logs: as-of lookups, ranges, segments, islands, batch breaks and gap filling.

As-of lookups use the window form (union, sort inside each key, last value): one shuffle
on the key, no nested loop.  Large keys are sorted in a task, but only their rows stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Left rows with the values of the last right row at or before their time (null if none).

    Right rows at the same time count; of several, the one with the greatest values.
    """
    l = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(_struct(right, values)))
    r = right.select(*keys, ts, F.struct(*values).alias("_v")).withColumn("_side", F.lit(0))
    both = l.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(ts), F.col("_side"), F.col("_v")).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_last", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*left.columns, *(F.col(f"_last.{v}").alias(v) for v in values))


def _struct(df: DataFrame, values: Sequence[str]) -> str:
    return "struct<" + ",".join(f"`{v}`:{df.schema[v].dataType.simpleString()}" for v in values) + ">"


def range_with_previous(log: DataFrame, keys: Sequence[str], ts: str, start: Column, end: Column, include_end: bool = False) -> DataFrame:
    """Rows in [start, end) (or to the end) and the last row before the start."""
    inside = F.col(ts) < end if not include_end else F.col(ts) <= end
    kept = log.where(inside)
    # The last time before the start is one small row per key.
    prior = F.max(F.when(F.col(ts) < start, F.col(ts))).over(Window.partitionBy(*keys))
    return kept.withColumn("_prior", prior).where((F.col(ts) >= start) | (F.col(ts) == F.col("_prior"))).drop("_prior")


def any_positive(log: DataFrame, keys: Sequence[str], ts: str, value: str, start: Column, end: Column) -> DataFrame:
    """Per key: whether the value was above zero in [start, end], the previous value included."""
    return range_with_previous(log, keys, ts, start, end, True).groupBy(*keys).agg((F.max(value) > 0).alias("on"))


def segments(log: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, ts: str) -> DataFrame:
    """Runs of equal state: keys, segment, state, start, end, n."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = F.coalesce((~F.col(state).eqNullSafe(F.lag(state).over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    marked = log.withColumn("_new", F.when(first, F.lit(0)).otherwise(changed))
    numbered = marked.withColumn("segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "segment", state).agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"))


def islands(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Runs of consecutive positions: keys, first, last, length."""
    w = Window.partitionBy(*keys).orderBy(position)
    run = df.withColumn("_run", F.col(position) - F.row_number().over(w))
    return run.groupBy(*keys, "_run").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("length")).drop("_run")


def largest_window(channels: DataFrame, limit: int, position: str = "chan", server: str = "server", masked: str = "masked") -> DataFrame:
    """The longest unmasked run: lowest server, and the last run of a server, on ties.

    Of ``limit`` channels or more: half of ``limit`` on each side of the run's middle channel, so
    ``last`` is the channel at which the window ends.  Of fewer: the whole run.
    """
    runs = islands(channels.where(~F.col(masked)), [server], position)
    best = runs.orderBy(F.desc("length"), F.asc(server), F.desc("first")).limit(1)
    middle = F.col("first") + F.floor(F.col("length") / 2)
    cut = F.col("length") >= limit
    first = F.when(cut, middle - limit // 2).otherwise(F.col("first")).cast("long")
    last = F.when(cut, middle + limit // 2).otherwise(F.col("last")).cast("long")
    return best.select(server, first.alias("first"), last.alias("last"))


#: Activities whose end doesn't close a batch.
QUIET = ("slew", "stop", "unknown", "await_pipeline")


def break_flag(keys: Sequence[str], order: Sequence[str], activity: str, activity_time: str, tags: str) -> Column:
    """1 where a batch closes before this dump because of a change of activity."""
    w = Window.partitionBy(*keys).orderBy(*order)
    old, old_time, old_tags = (F.lag(c).over(w) for c in (activity, activity_time, tags))
    changed = old_time != F.col(activity_time)
    noisy = ~F.rlike(old, F.lit("|".join(QUIET)))
    by_activity = changed & noisy & ~F.contains(F.col(tags), F.lit("unknown")) & ~F.contains(old_tags, F.lit("target"))
    by_tag = changed & F.contains(old_tags, F.lit("single_accumulation"))
    return F.coalesce((by_activity | by_tag).cast("int"), F.lit(0))


def batches(dumps: DataFrame, keys: Sequence[str], order: Sequence[str], max_length: int, activity: str = "activity", activity_time: str = "activity_time", tags: str = "tags") -> DataFrame:
    """Dumps with ``session`` (broken by activity) and ``batch`` inside it (broken by size)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = dumps.withColumn("_break", break_flag(keys, order, activity, activity_time, tags))
    session = marked.withColumn("session", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")
    inner = Window.partitionBy(*keys, "session").orderBy(*order)
    return session.withColumn("batch", F.floor((F.row_number().over(inner) - 1) / max_length).cast("int"))


def gaps(df: DataFrame, keys: Sequence[str], index: str) -> DataFrame:
    """Rows with ``lost_after``: how many indices of their key are missing up to the next one.

    The last row of a key, and all but one of an equal index, have none.  Rows without an index are left out.
    """
    w = Window.partitionBy(*keys).orderBy(index)
    nxt = F.coalesce(F.lead(index).over(w), F.col(index) + 1)
    return df.where(F.col(index).isNotNull()).withColumn("lost_after", F.greatest(F.lit(0).cast("long"), (nxt - F.col(index) - 1).cast("long")))


def fill_gaps(df: DataFrame, keys: Sequence[str], index: str, values: Sequence[str], lost: int) -> DataFrame:
    """A row for every index from the first to the last of each key.

    Each row brings the missing indices up to the next one, so no key is gathered.
    Missing rows have null values and ``flags`` = ``lost``.  What is only to be counted is counted from ``gaps``,
    without a row per missing index.
    """
    spread = gaps(df, keys, index).withColumn("_i", F.explode(F.sequence(F.col(index), (F.col(index) + F.col("lost_after")).cast(df.schema[index].dataType))))
    real = F.col("_i") == F.col(index)
    return spread.select(*keys, F.col("_i").alias(index), *(F.when(real, F.col(v)).alias(v) for v in values), F.when(real, F.col("flags")).otherwise(F.lit(lost)).alias("flags"))


def first_writer(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key (later writers are ignored)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def last_writer(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")

"""Medians and counts over solutions and summaries; NaN and null are skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import cplx

#: Median absolute deviation to standard deviation of a normal distribution.
NMAD = 1.4826


def median(x: Column) -> Column:
    return F.percentile(cplx.clean(x), F.lit(0.5))


#: Ranks of the sketch in ``quantiles``: cuts are within one in so many of a rank.
RANKS = 10_000


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles (linear between two ranks) per key, for keys that hold any share of the rows.

    First cuts close to both sides of each share, from a sketch of bounded size, and counts between them.  Then only the
    buckets that hold the wanted ranks, narrow ones, are ranked, so no task holds all values of a key.  Wherever the
    cuts fall the result is exact: a bucket that they miss is only wider.
    """
    x = cplx.clean(F.col(value).cast("double"))
    rows = df.select(*keys, x.alias("_x")).where("_x IS NOT NULL")
    near = sorted({min(1.0, max(0.0, q + d / RANKS)) for q in shares for d in (-3, 3)})
    cuts = rows.groupBy(*keys).agg(F.percentile_approx("_x", near, RANKS).alias("_cuts"))
    # A few comparisons a row; the number of cuts is that of the shares.
    below = sum(((F.col("_cuts")[k] < F.col("_x")).cast("int") for k in range(len(near))), F.lit(0))
    placed = rows.join(cuts, list(keys)).select(*keys, "_x", below.alias("_bucket"))
    buckets = placed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n")).withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    at = F.array(*((F.lit(float(q)) * (F.col("_total") - 1)).alias(f"q{k}") for k, q in enumerate(shares)))
    ranks = F.array_distinct(F.flatten(F.transform(at, lambda r: F.array(F.floor(r), F.ceil(r)))))
    wanted = F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_end")))
    chosen = buckets.withColumn("_ranks", wanted).where(F.size("_ranks") > 0).select(*keys, "_bucket", "_start", "_total", "_ranks")
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    # Equal values are one row with their number.
    values = placed.join(chosen.select(*keys, "_bucket"), [*keys, "_bucket"], "left_semi").groupBy(*keys, "_bucket", "_x").agg(F.count("*").alias("_n"))
    ranked = values.join(chosen, [*keys, "_bucket"]).withColumn("_last", F.col("_start") + F.sum("_n").over(inside)).withColumn("_first", F.col("_last") - F.col("_n"))
    hit = ranked.withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_first")) & (r < F.col("_last")))))
    found = hit.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_m"), F.first("_total").alias("_total"))  # two ranks a share

    def pick(q: float) -> Column:
        r = F.lit(float(q)) * (F.col("_total") - 1)
        lo, hi = F.element_at("_m", F.floor(r)), F.element_at("_m", F.ceil(r))
        return lo + (hi - lo) * (r - F.floor(r))

    return found.select(*keys, *(pick(q).alias(n) for q, n in zip(shares, names, strict=True)))


def phase_nmad(df: DataFrame, over: Sequence[str], per: Sequence[str], phase: str = "phase") -> DataFrame:
    """1.4826 times the median deviation of the phase from its median.

    ``over``: keys of the inner median; ``per``: keys of the result.
    """
    inner = df.groupBy(*over).agg(median(F.col(phase)).alias("_mid"))
    return df.join(inner, list(over)).groupBy(*per).agg((median(F.abs(F.col(phase) - F.col("_mid"))) * NMAD).alias("nmad"))


def amplitude_range(df: DataFrame, pol: str = "pol", amp: str = "amp", sigmas: float = 3.0) -> DataFrame:
    """(low, high) over the polarisations of median -/+ sigmas * NMAD; low at least zero."""
    mid = quantiles(df, [pol], amp, [0.5], ["mid"])
    apart = df.join(mid, pol).withColumn("_apart", F.abs(F.col(amp) - F.col("mid")))
    dev = quantiles(apart, [pol], "_apart", [0.5], ["dev"]).join(mid, pol).withColumn("dev", F.col("dev") * (NMAD * sigmas))
    return dev.agg(F.greatest(F.lit(0.0), F.min(F.col("mid") - F.col("dev"))).alias("low"), F.max(F.col("mid") + F.col("dev")).alias("high"))


def quartiles(df: DataFrame, keys: Sequence[str], value: str = "snr") -> DataFrame:
    return quantiles(df, keys, value, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


def low_snr_count(df: DataFrame, keys: Sequence[str], limit: float, value: str = "snr") -> DataFrame:
    """Values below the limit; NaN and null count as zero."""
    return df.groupBy(*keys).agg(F.count_if(F.coalesce(cplx.clean(F.col(value)), F.lit(0.0)) < limit).alias("n_low"))


def solution_counts(df: DataFrame, keys: Sequence[str], value: str = "re") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(cplx.clean(F.col(value))).alias("n_solutions"))


def bad_antennas(df: DataFrame, pol: str = "pol", ant: str = "ant", value: str = "re") -> DataFrame:
    """Antennas of each polarisation whose values are all missing, as one sorted label."""
    empty = df.groupBy(pol, ant).agg(F.count(cplx.clean(F.col(value))).alias("n")).where("n = 0")
    return empty.groupBy(pol).agg(F.array_join(F.array_sort(F.collect_list(F.col(ant).cast("string"))), ",").alias("bad"))


def error_limits(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and five population standard deviations."""
    x = cplx.clean(F.col(value))
    return df.groupBy(*keys).agg(F.avg(x).alias("mean"), (F.stddev_pop(x) * 5).alias("limit"))

"""Static masks: ranges of frequency that are never used, on all baselines or on short ones.

A channel is masked where the channel, with its width, overlaps a range (ends included).  A range with a
``max_length`` holds for baselines up to that length.  Ranges and channels meet in an equal join on bins of
frequency, so no channel is compared with every range: bins are as wide as a channel, a range in
``most`` bins or more is taken by coarser bins (each level ``most`` times as wide), and each channel asks every
level once.  For each channel only the longest baseline that is masked matters, so ranges are
reduced to one number per channel before baselines come in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a range at one level, and levels.
MOST, LEVELS = 16, 6


def masked_lengths(channels: DataFrame, ranges: DataFrame, width_hz: float, keys: Sequence[str] = ("chan",)) -> DataFrame:
    """Keys and ``masked_to``: the longest baseline (m) that is masked in the channel, infinite for all; unmasked channels are left out.

    ``channels``: keys, freq_hz (the centre); ``ranges``: lo, hi (Hz), max_length (null: any).  Ranges without ends or of negative width are ignored.
    """
    known = ranges.where("lo <= hi").select("lo", "hi", F.coalesce(F.col("max_length").cast("double"), F.lit(float("inf"))).alias("length"))
    size = lambda level: F.lit(width_hz) * F.pow(F.lit(float(MOST)), level)
    # A range's level: the first in which it has no more than MOST bins (the last takes all longer ones, too).
    least = F.ceil(F.log((F.col("hi") - F.col("lo")) / width_hz / MOST + 1e-12) / F.log(F.lit(float(MOST))))
    leveled = known.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), least)).cast("int"))
    bin_of = lambda x: F.floor(x / size(F.col("level"))).cast("long")
    spread = leveled.withColumn("bin", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))))
    half = F.lit(width_hz / 2)
    low, high = F.col("freq_hz") - half, F.col("freq_hz") + half
    asked = channels.select(*keys, "freq_hz").withColumn("level", F.explode(F.array(*(F.lit(k) for k in range(LEVELS)))))
    asked = asked.withColumn("bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    hits = asked.join(spread, ["level", "bin"]).where((high >= F.col("lo")) & (low <= F.col("hi")))
    return hits.groupBy(*keys).agg(F.max("length").alias("masked_to"))


def baseline_mask(channels: DataFrame, baselines: DataFrame, ranges: DataFrame, width_hz: float, keys: Sequence[str] = ("chan",)) -> DataFrame:
    """A row per channel and baseline (ant1, ant2, length in m): ``masked``."""
    found = masked_lengths(channels, ranges, width_hz, keys)
    marked = channels.join(found, list(keys), "left")
    # Every channel of every baseline is the result; both are dimensions of the instrument.
    return marked.crossJoin(baselines).withColumn("masked", F.coalesce(F.col("length") <= F.col("masked_to"), F.lit(False))).drop("masked_to")


def flag_masked(vis: DataFrame, channels: DataFrame, baselines: DataFrame, ranges: DataFrame, width_hz: float, bit: int) -> DataFrame:
    """Visibilities with the bit set on masked channels of their baseline; baselines without a length count as length 0."""
    found = masked_lengths(channels, ranges, width_hz)
    rows = vis.join(found, "chan", "left").join(baselines.select("ant1", "ant2", "length"), ["ant1", "ant2"], "left")
    hit: Column = F.coalesce(F.coalesce("length", F.lit(0.0)) <= F.col("masked_to"), F.lit(False))
    return rows.withColumn("flags", F.when(hit, F.col("flags").bitwiseOR(F.lit(bit))).otherwise(F.col("flags"))).select(*vis.columns)

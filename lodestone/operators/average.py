"""Flag-aware weighted averages over any axis.

The input has one row per cell: key columns, ``re``, ``im``, ``flags`` (integer bits) and
``weight``.  An axis is averaged by leaving it out of ``keys``; a block average puts a
floor expression among them.  All averages are sums of partial sums, so Spark combines
them before its one shuffle on the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import cplx


def _good() -> Column:
    return (F.col("flags") == 0) & F.col("re").isNotNull() & F.col("im").isNotNull() & cplx.positive(F.col("weight"))


def partial_sums(df: DataFrame, keys: Sequence[Column | str], *extra: Column) -> DataFrame:
    """Mergeable sums per key: swr, swi, sw (unflagged), n_flagged, n."""
    w = F.when(_good(), F.col("weight").cast("double"))
    return df.groupBy(*keys).agg(
        F.sum(w * F.col("re")).alias("swr"),
        F.sum(w * F.col("im")).alias("swi"),
        F.sum(w).alias("sw"),
        F.sum((F.col("flags") != 0).cast("long")).alias("n_flagged"),
        F.count("*").alias("n"),
        *extra,
    )


def merge_sums(parts: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Merge tables of partial sums (summaries of several batches)."""
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("swr", "swi", "sw", "n_flagged", "n")))


def finish(sums: DataFrame, threshold: float = 1.0) -> DataFrame:
    """re, im, weight, flags: an average is flagged if the flagged share reaches the threshold."""
    flagged = (F.col("n_flagged") >= F.lit(threshold) * F.col("n")) | F.col("sw").isNull()
    return (
        sums.withColumn("re", F.col("swr") / F.col("sw"))
        .withColumn("im", F.col("swi") / F.col("sw"))
        .withColumn("weight", F.coalesce("sw", F.lit(0.0)))
        .withColumn("flags", flagged.cast("int"))
        .drop("swr", "swi", "sw", "n_flagged", "n")
    )


def wavg(df: DataFrame, keys: Sequence[Column | str], threshold: float = 1.0, *extra: Column) -> DataFrame:
    return finish(partial_sums(df, keys, *extra), threshold)


def solution_interval(n_dumps: Column, nominal: int | Column) -> Column:
    """Dumps per interval: near the nominal number, dividing the scan as evenly as possible."""
    nominal = F.lit(nominal) if isinstance(nominal, int) else nominal
    intervals = F.greatest(F.lit(1), F.round(n_dumps / nominal))
    return F.when(n_dumps <= nominal, F.greatest(F.lit(1), n_dumps)).otherwise(F.ceil(n_dumps / intervals)).cast("long")


def wavg_solint(df: DataFrame, nominal: int, keys: Sequence[str], scan: Sequence[str], dump: str = "dump") -> DataFrame:
    """Average per solution interval of each scan, counted from the scan's own first dump; mean dump as ``mean_dump``.

    The scans' starts and lengths are an aggregate of a row per scan, joined back.
    """
    per = solution_interval(F.col("_n"), nominal)
    scans = df.select(*scan, dump).distinct().groupBy(*scan).agg(F.min(dump).alias("_start"), F.count("*").alias("_n")).withColumn("_per", per)
    binned = df.join(scans, list(scan)).withColumn("solint", F.floor((F.col(dump) - F.col("_start")) / F.col("_per")).cast("int"))
    return wavg(binned, [*scan, "solint", *keys], 1.0, F.avg(dump).alias("mean_dump"))


def per_antenna(df: DataFrame, conjugate_second: bool = False) -> DataFrame:
    """A row per antenna of each baseline; optionally the conjugate for the second antenna."""
    ends = F.explode(F.array(F.struct(F.col("ant1").alias("ant"), F.lit(1.0).alias("sign")), F.struct(F.col("ant2").alias("ant"), F.lit(-1.0 if conjugate_second else 1.0).alias("sign"))))
    out = df.withColumn("_end", ends)
    return out.withColumn("im", F.col("im") * F.col("_end.sign")).withColumn("ant", F.col("_end.ant")).drop("_end")


def wavg_antenna(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wavg(per_antenna(df), [*keys, "ant"])


def summarize_full(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average over time per baseline, then per antenna; weights and flags stay."""
    return wavg_antenna(wavg(df, [*keys, "ant1", "ant2"]), keys)


def summarize(df: DataFrame, keys: Sequence[str], refant: int | None = None, ts: str = "ts", antennas: bool = False) -> DataFrame:
    """Average over time per baseline (or antenna), flagged ones null, stamped with the mean time; optionally of the reference antenna's baselines alone."""
    if refant is not None:
        df = df.where((F.col("ant1") == refant) != (F.col("ant2") == refant))
    mean = wavg(df, [*keys, "ant1", "ant2"], 1.0, F.avg(ts).alias(ts))
    if antennas:
        mean = wavg(per_antenna(mean), [*keys, "ant"], 1.0, F.avg(ts).alias(ts))
    good = F.col("flags") == 0
    return mean.withColumn("re", F.when(good, F.col("re"))).withColumn("im", F.when(good, F.col("im")))


def weight_data(df: DataFrame) -> DataFrame:
    """Weighted values: flagged cells have weight and value zero."""
    w = F.when(_good(), F.col("weight")).otherwise(F.lit(0.0))
    return df.withColumn("weight", w).withColumn("re", F.coalesce(F.col("re") * w, F.lit(0.0))).withColumn("im", F.coalesce(F.col("im") * w, F.lit(0.0)))


def combine_cross_hands(df: DataFrame, keys: Sequence[str], first: str = "hv", second: str = "vh") -> DataFrame:
    """(w HV + conj(w VH)) / sum w per key; zero where nothing has weight."""
    w = weight_data(df.where(F.col("pol").isin(first, second)))
    sums = w.groupBy(*keys).agg(
        F.sum("re").alias("swr"), F.sum(F.when(F.col("pol") == second, -F.col("im")).otherwise(F.col("im"))).alias("swi"), F.sum("weight").alias("weight")
    )
    out = sums.withColumn("re", cplx.safe_divide(F.col("swr"), F.col("weight"))).withColumn("im", cplx.safe_divide(F.col("swi"), F.col("weight")))
    return out.drop("swr", "swi")


def flag_percent(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Percentage of flagged cells per key."""
    return df.groupBy(*keys).agg((F.avg((F.col("flags") != 0).cast("double")) * 100).alias("flag_pct"))


def flag_summaries(df: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """(flag counts per channel block, pol, baseline; mean flagged share per channel block and pol)."""
    cells = df.withColumn("block", F.floor(F.col("chan") / block).cast("int"))
    by_bl = cells.groupBy("block", "pol", "bl").agg(F.sum((F.col("flags") != 0).cast("long")).alias("n_flagged"), F.count("*").alias("n"))
    return by_bl, by_bl.groupBy("block", "pol").agg((F.sum("n_flagged") / F.sum("n")).alias("share"))


def combine_channel_flags(df: DataFrame, factor: int, keys: Sequence[str]) -> DataFrame:
    """Flags of ``factor`` adjacent channels as one: OR of the cells not excised, of all if every one is."""
    kept = F.bit_or(F.when(~F.col("excise"), F.col("flags")))
    every = F.bit_or("flags")
    return df.groupBy(*keys, F.floor(F.col("chan") / factor).cast("int").alias("chan")).agg(F.coalesce(kept, every).alias("flags"), F.min(F.col("excise").cast("int")).alias("excise"))


def block_frequencies(channels: DataFrame, block: int) -> DataFrame:
    """Mean channel and frequency of each block (a short last block by its own size)."""
    b = F.floor(F.col("chan") / block).cast("int").alias("block")
    return channels.groupBy(b).agg(F.avg("chan").alias("chan"), F.avg("freq_hz").alias("freq_hz"), (F.sum("freq_hz") / block).alias("freq_full_block"))


def normalise_complex(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Factor per key that makes the weighted mean of the values one: conj(mean) / |mean|^2."""
    mean = wavg(df, keys)
    re, im = cplx.reciprocal((F.col("re"), F.col("im")))
    return mean.select(*keys, re.alias("re"), im.alias("im"))


def power_scale(df: DataFrame, autos: DataFrame) -> DataFrame:
    """Weights divided by the autocorrelation powers of both inputs at the same dump and channel.

    ``autos``: dump, chan, input, power.  Zero, NaN or missing power gives weight zero.
    """
    a = autos.select("dump", "chan", F.col("input").alias("input1"), F.col("power").alias("power1"))
    b = autos.select("dump", "chan", F.col("input").alias("input2"), F.col("power").alias("power2"))
    out = df.join(a, ["dump", "chan", "input1"], "left").join(b, ["dump", "chan", "input2"], "left")
    return out.withColumn("weight", cplx.safe_divide(F.col("weight"), F.col("power1") * F.col("power2"))).drop("power1", "power2")

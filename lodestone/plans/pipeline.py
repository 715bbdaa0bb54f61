"""Calibration of one or more calibrator scans without tags, and interference flags.

All delays are solved in one job, then bandpasses with the delays applied, then gains; each
product is a table before the next one reads it.  The tag-driven plan of a whole observation
is in ``reduction``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators import apply, average, rfi, solve
from lodestone.sources.scratch import written


def parallel_hands(vis: DataFrame) -> DataFrame:
    return vis.where("pol1 = pol2 and ant1 <> ant2").withColumn("pol", F.col("pol1"))


def cross_hands(vis: DataFrame, autos: bool) -> DataFrame:
    return vis.where("pol1 <> pol2").where("ant1 = ant2" if autos else "ant1 <> ant2").withColumn("pol", F.concat("pol1", "pol2"))


def calibrate(vis: DataFrame, channels: DataFrame, n_ants: int, ref: int) -> dict[str, DataFrame]:
    """K, B and G of a table of one or more calibrator scans (column ``scan``).

    Each product is averaged over time before its solve, so a group of the solver holds one
    scan, one polarisation and the baselines' spectra.
    """
    hands = parallel_hands(vis)
    spectra = written(average.wavg(hands, ["scan", "chan", "pol", "ant1", "ant2"]), "spectra")
    k = written(solve.solve_delays(spectra, channels, ["scan"], n_ants, ref), "delays")
    no_delay = apply.apply_gains(spectra, _by_scan(k, channels), ["scan", "chan"], True)
    blocks = no_delay.withColumn("block", F.floor(F.col("chan") / 64).cast("int"))
    b = written(solve.solve_gains(blocks, ["scan", "block"], n_ants, ref).drop("block"), "bandpasses")
    flat = apply.apply_gains(no_delay, b.select("scan", "chan", "pol", "ant", "re", "im"), ["scan", "chan"], True)
    whole = average.wavg(flat, ["scan", "pol", "ant1", "ant2"]).withColumn("chan", F.lit(0))
    g = solve.solve_gains(whole, ["scan"], n_ants, ref).drop("chan")
    return {"K": k, "B": b, "G": g}


def _by_scan(delays: DataFrame, channels: DataFrame) -> DataFrame:
    from lodestone.functions import cplx

    re, im = cplx.delay_phasor(F.col("delay"), F.col("freq_hz"))
    return delays.crossJoin(channels).select("scan", "chan", "pol", "ant", re.alias("re"), im.alias("im"))


def apply_all(vis: DataFrame, products: dict[str, DataFrame], channels: DataFrame) -> DataFrame:
    """Visibilities of all four hands with K, B and G applied; weights stay as they are."""
    v = vis.withColumnRenamed("pol", "_hand").withColumn("pol", F.col("pol1"))
    for name in ("K", "B", "G"):
        if name not in products:
            continue
        gains = _by_scan(products[name], channels) if name == "K" else products[name]
        on = ["scan", "chan"] if name != "G" else ["scan"]
        v = apply.apply_gains(v, gains, on, False, F.col("pol1"), F.col("pol2"))
    return v.drop("pol").withColumnRenamed("_hand", "pol")


def flag_rows(vis: DataFrame, **kw) -> DataFrame:
    """Interference flags of each row's own hand, scan by scan."""
    return rfi.flag_interference(vis, ("scan", "pol", "ant1", "ant2"), **kw)


def flag(vis: DataFrame, **kw) -> DataFrame:
    """Interference flags from the cross hands, set on all hands of the cell."""
    found = rfi.flag_interference(vis.where("pol1 <> pol2"), **kw)
    new = found.where(F.col("flags").bitwiseAND(F.lit(rfi.CAL_RFI)) != 0).select("dump", "chan", "ant1", "ant2").distinct().withColumn("_hit", F.lit(rfi.CAL_RFI))
    return vis.join(new, ["dump", "chan", "ant1", "ant2"], "left").withColumn("flags", F.col("flags").bitwiseOR(F.coalesce("_hit", F.lit(0)))).drop("_hit")

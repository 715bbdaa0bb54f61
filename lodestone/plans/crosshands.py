"""Cross-hand delays and phases: from polarisation calibrators, and from a noise diode on beamformer calibrators.

* ``KCROSS`` of ``polcal`` scans: the cross-correlations, with K, B and preliminary gains applied, give one delay a scan;
* ``KCROSS_DIODE`` and ``BCROSS_DIODE`` of ``bfcal`` scans: the autocorrelations of antennas whose diode was on, with K, B
  and G applied, give a delay per antenna, and with the antennas' median delay applied a phase per channel and antenna;
* ``BCROSS_DIODE_SKY``: the antennas' median phase, turned by a spline of the frequency, for every antenna.

A gain of the first polarisation takes it all; that of the second is one (or a delay of zero).  Both hands count: VH is
conjugated and averaged with HV by weight, so every solution is one aggregate over dumps (and baselines) before numpy
sees a spectrum.  Antennas without a diode have no value, and a scan in which no diode was on has no rows.  A hand that is
missing or flagged throughout leaves the other alone on autocorrelations, and drops the baseline on cross-correlations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import cplx
from lodestone.operators import apply, average, sensors, solve
from lodestone.plans import reduction
from lodestone.sources.scratch import written

POL_TAGS, DIODE_TAGS = ("polcal",), ("bfcal",)


def _hands(first: str) -> tuple[str, str]:
    second = "v" if first == "h" else "h"
    return first + second, second + first


def cross_rows(rows: DataFrame, first: str = "h") -> DataFrame:
    return rows.where(F.col("pol").isin(*_hands(first)))


def parallel_rows(rows: DataFrame) -> DataFrame:
    """Cross-correlations of equal hands, with one letter for the hand."""
    letter = F.substring("pol", 1, 1)
    return rows.where((letter == F.substring("pol", -1, 1)) & (F.col("ant1") != F.col("ant2"))).withColumn("pol", letter)


def channel_blocks(channels: DataFrame, window: tuple[int, int] | None, size: int) -> DataFrame:
    """(chan, block): blocks of ``size`` channels from the window's first on; channels outside it are left out."""
    first = window[0] if window else 0
    return channels.where(reduction.inside(window)).select("chan", "freq_hz", F.floor((F.col("chan") - first) / size).cast("int").alias("block"))


def _delays(cells: DataFrame, blocks: DataFrame, keys: list[str], first: str) -> DataFrame:
    """Delay per key of combined cells (keys, block, re, im, weight)."""
    centres = blocks.groupBy(F.col("block").alias("chan")).agg(F.avg("freq_hz").alias("freq_hz"))
    return solve.solve_cross_delay(cells.withColumnRenamed("block", "chan"), centres, keys, first)


def with_second(solution: DataFrame, first: str, **values: Column) -> DataFrame:
    """The solution of the first polarisation and, for the second, the same keys with other values (null where the first is null)."""
    second = _hands(first)[0][1]
    return solution.unionByName(solution.withColumn("pol", F.lit(second)).withColumns({c: F.when(F.col(c).isNotNull(), v) for c, v in values.items()}))


def preliminary_gains(rows: DataFrame, solint: int | None, window: tuple[int, int] | None, n_ants: int, ref: int) -> DataFrame:
    """(scan, ts, pol, ant, re, im): gains per ``solint`` dumps (None: the scan) of the parallel hands in the window."""
    hands = parallel_rows(rows).where(reduction.inside(window))
    nominal = F.col("_n") if solint is None else F.lit(solint)
    solved = reduction.interval_gains(hands, nominal, n_ants, ref).select("scan", F.col("time").alias("ts"), "pol", "ant", "re", "im")
    return written(solved, "preliminary")


def with_delay(rows: DataFrame, delays: DataFrame, soltype: str, channels: DataFrame, ants: DataFrame, weights: bool = True) -> DataFrame:
    """Rows divided by a cross-hand delay, the same for all antennas (their median where they have one each)."""
    gains = apply.gain_table(delays, soltype, channels, ["scan"], ants)
    return reduction._applied(rows, gains, ["scan", "chan"], weights)


def solve_polcal(rows: DataFrame, scans: DataFrame, channels: DataFrame, band: DataFrame, n_ants: int, ref: int, settings: reduction.Settings = reduction.Settings(), first: str = "h", tiles: int = 1) -> dict[str, DataFrame]:
    """``KCROSS`` (scan, pol, delay) of the polarisation calibrators and ``cross``, their corrected average on the reference's baselines."""
    s = settings
    own = reduction._of(rows, scans, POL_TAGS).where("ant1 <> ant2")
    flat = written(apply.divide_scans(own, band, weights=True, tiles=tiles), "polcal")
    early = preliminary_gains(flat, s.k_solint, s.k_window, n_ants, ref)
    flat = written(cross_rows(apply.divide_scans(flat, knots=early, weights=True, tiles=tiles), first), "crossed")
    blocks = written(channel_blocks(channels, s.k_window, s.kcross_average), "blocks")
    # By baseline first: one of which a hand has nothing is left out.
    hv, vh = _hands(first)
    cells = flat.join(blocks.select("chan", "block"), "chan").withColumn("weight", F.when(F.col("flags") == 0, F.col("weight")).otherwise(0.0))
    has = [F.max(F.when(F.col("pol") == p, cplx.positive(F.col("weight")) & F.col("re").isNotNull()).otherwise(False)) for p in (hv, vh)]
    whole = cells.groupBy("scan", "block", "ant1", "ant2").agg((has[0] & has[1]).alias("_both")).where("_both").drop("_both")
    by_baseline = average.combine_cross_hands(cells, ["scan", "block", "ant1", "ant2"], hv, vh).join(whole, ["scan", "block", "ant1", "ant2"], "left_semi")
    mean = average.wavg(by_baseline.withColumn("flags", F.lit(0)), ["scan", "block"]).drop("flags")
    k = written(with_second(_delays(mean, blocks, ["scan"], first), first, delay=F.lit(0.0)), "kcross")
    ants = rows.sparkSession.range(n_ants).select(F.col("id").cast("int").alias("ant"))
    straight = with_delay(flat, k, "KCROSS", channels, ants, False)
    return {"KCROSS": k, "cross": average.summarize(straight, ["scan", "chan", "pol"], ref)}


def diodes_on(scans: DataFrame, diode: DataFrame) -> DataFrame:
    """(scan, ant): diodes above zero at some time of the scan, or at the last reading before it.

    ``diode``: ant, ts, value.  Readings within a scan by bins of time, the one before by an as-of join.
    """
    ants = diode.select("ant").distinct()
    # Strictly before the start: readings at the start are within.
    asked = scans.select("scan", (F.col("t0") - 1e-6).alias("ts")).crossJoin(ants)
    before = sensors.asof(asked, diode.select("ant", "ts", "value"), ["ant"], "ts", ["value"]).where("value > 0").select("scan", "ant")
    within = reduction.with_scans(diode.where("value > 0").select("ant", "ts"), scans.select("scan", "t0", "t1")).select("scan", "ant")
    return before.unionByName(within).distinct()


def complex_median(z: DataFrame, keys: list[str]) -> DataFrame:
    """Median per key of complex values by real, then imaginary part; the mean of the middle two of an even number.

    A key's values are one per antenna.  Null values don't count; a key of nulls alone has a null median.
    """
    cell = F.when(F.col("re").isNotNull() & F.col("im").isNotNull(), F.struct("re", "im"))
    sets = z.groupBy(*keys).agg(F.array_sort(F.collect_list(cell)).alias("_z"))
    n = F.size("_z")
    lo, hi = (F.get("_z", F.floor((n - d) / 2).cast("int")) for d in (1, 0))
    some = n > 0
    return sets.select(*keys, *(F.when(some, (lo[c] + hi[c]) / 2).alias(c) for c in ("re", "im")))


def solve_diode(rows: DataFrame, scans: DataFrame, channels: DataFrame, band: DataFrame, gains: DataFrame, diode: DataFrame, settings: reduction.Settings = reduction.Settings(), first: str = "h") -> dict[str, DataFrame]:
    """``KCROSS_DIODE`` (scan, pol, ant, delay), ``BCROSS_DIODE`` and ``BCROSS_DIODE_SKY`` (scan, chan, pol, ant, re, im; the
    latter if there is a spline) of the beamformer calibrators, and ``auto_cross``, their corrected average.

    ``gains``: G of the scans (scan, pol, ant, re, im), one interval each.
    """
    hv, vh = _hands(first)
    on = written(diodes_on(scans.where(reduction.has_any(DIODE_TAGS)), diode), "diodes").withColumn("_on", F.lit(True))
    own = cross_rows(rows.where("ant1 = ant2"), first).join(on.select("scan").distinct(), "scan", "left_semi")
    flat = reduction._applied(reduction._applied(own, band, ["scan", "chan"], True), gains, ["scan"], True)
    flat = written(flat.withColumn("ant", F.col("ant1")), "autos")
    blocks = written(channel_blocks(channels, settings.k_window, settings.kcross_average), "blocks")
    cells = average.combine_cross_hands(flat.join(blocks.select("chan", "block"), "chan"), ["scan", "block", "ant"], hv, vh)
    k = _delays(cells, blocks, ["scan", "ant"], first).join(on, ["scan", "ant"], "left").withColumn("delay", F.when(F.col("_on"), F.col("delay"))).drop("_on")
    k = written(with_second(k, first, delay=F.lit(0.0)), "kcross_diode")
    ants = k.select("scan", "ant").distinct()
    straight = written(with_delay(flat, k.where("delay IS NOT NULL"), "KCROSS_DIODE", channels, ants), "straight")
    phase = solve.cross_phase(average.combine_cross_hands(straight, ["scan", "chan", "ant"], hv, vh)).join(on, ["scan", "ant"], "left")
    phase = phase.select("scan", "chan", F.lit(first).alias("pol"), "ant", *(F.when(F.col("_on"), F.col(c)).alias(c) for c in ("re", "im")))
    b = written(with_second(phase, first, re=F.lit(1.0), im=F.lit(0.0)), "bcross_diode")
    out = {"KCROSS_DIODE": k, "BCROSS_DIODE": b}
    if settings.sky_spline is not None:
        out["BCROSS_DIODE_SKY"] = to_sky(b, channels, settings.sky_spline, first)
    fixed = reduction._applied(straight, b, ["scan", "chan"], False)
    out["auto_cross"] = average.summarize(fixed, ["scan", "chan", "pol"])
    return out


def to_sky(bcross: DataFrame, channels: DataFrame, spline: tuple[list[float], list[float], int], first: str = "h") -> DataFrame:
    """The antennas' median phases, those of the first polarisation turned by the spline (degrees of HV by MHz), for every antenna."""
    middle = complex_median(bcross, ["scan", "chan", "pol"]).join(channels.select("chan", "freq_hz"), "chan")
    turned = solve.rotate_by_spline(middle.where(F.col("pol") == first), *spline, first == "v").unionByName(middle.where(F.col("pol") != first))
    return turned.drop("freq_hz").join(bcross.select("scan", "chan", "pol", "ant"), ["scan", "chan", "pol"]).select("scan", "chan", "pol", "ant", "re", "im")

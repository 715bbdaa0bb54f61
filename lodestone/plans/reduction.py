"""Tag-driven reduction of an observation: solve K, B and G on calibrators, apply them to every scan.

Scans are taken by product, not one after the other: all delays are solved in one job (a
group per baseline, then one per scan), then the bandpasses with the delays applied, then
the gains, and each product is a table before the next one reads it.  Which solution a scan
sees is decided by ``proc_seq`` (batch ascending, scan descending), as if the scans had been
processed one by one, newest first:

* K and B: the last one solved up to the scan itself;
* G: those within ``WINDOW_S`` of the scan solved up to the scan itself, of its own target if
  there are any and else of all, interpolated to each dump, the ends held;
* a scan for which a product has no solution goes on without it.

K and B come from ``delaycal`` and ``bpcal`` scans, G from ``gaincal`` ones in intervals near ``g_solint`` that divide
the scan evenly, and all three from ``bfcal`` scans, whose G is one interval; a ``bpcal`` scan that is
no ``gaincal`` gives one G, too.

Before K and B are solved, relative gains per ``k_solint`` and ``bp_solint`` are solved on the window's channels
and taken off every dump, so a calibrator may drift while it is observed.  A model of the source divides the
calibrators first, and interference is flagged, if they are given.  Scans of several capture blocks (``cb``) may stand
in one table: none sees another block's solutions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import cplx, keys
from lodestone.operators import apply, average, interp, rfi, solve
from lodestone.sources.scratch import ROWS, together, written

WINDOW_S = 7200.0
BIN_S = 600.0

DELAY_TAGS, BAND_TAGS, GAIN_TAGS = ("delaycal", "bfcal"), ("bpcal", "bfcal"), ("gaincal", "bpcal", "bfcal")
APPLY_TAGS = ("gaincal", "target", "bfcal", "bpcal", "delaycal")


@dataclass(frozen=True)
class Settings:
    """What a plan takes from the parameters: windows of channels [begin, end), intervals in dumps, flaggers."""

    k_window: tuple[int, int] | None = None
    g_window: tuple[int, int] | None = None
    k_solint: int | None = None
    bp_solint: int | None = None
    #: None: two intervals a scan.
    g_solint: int | None = None
    k_chan_sample: int = 1
    #: Of calibrators and of targets.
    flaggers: tuple[rfi.Flagger, rfi.Flagger] | None = None
    #: Whether interference is sought in the cross hands and set on all hands, or sought in each hand.
    flag_cross: bool = False
    #: Channels averaged before a cross-hand delay, and the (knots in MHz, coefficients in degrees, degree) of the sky's phase.
    kcross_average: int = 1
    sky_spline: tuple[list[float], list[float], int] | None = None

    @classmethod
    def of_parameters(cls, p: dict, dump_period: float, n_chans: int, flag_cross: bool = True) -> Settings:
        """Of resolved parameters (``params.resolve``)."""
        dumps = {k: max(1, round(p[k] / dump_period)) for k in ("k_solint", "bp_solint", "g_solint")}
        windows = {f"{k}_window": (p[f"{k}_bchan"], p[f"{k}_echan"]) for k in ("k", "g")}
        flaggers = tuple(rfi.Flagger.of_parameters(p, dump_period, n_chans, kind) for kind in ("calib", "targ"))
        spline = tuple(p.get(f"bcross_sky_{n}") for n in ("knots", "coefs", "k"))
        # Coefficients of nothing but zeros stand for no spline.
        sky = spline if spline[1] and any(spline[1]) else None
        return cls(**windows, **dumps, k_chan_sample=p["k_chan_sample"], flaggers=flaggers, flag_cross=flag_cross, kcross_average=p.get("kcross_chanave", 1), sky_spline=sky)


def inside(window: tuple[int, int] | None) -> Column:
    return F.lit(True) if window is None else (F.col("chan") >= window[0]) & (F.col("chan") < window[1])


def blocks(scans: DataFrame) -> DataFrame:
    """The scans with their capture block (one for all if the table has none)."""
    return scans if "cb" in scans.columns else scans.withColumn("cb", F.lit(""))


def processing_order(scans: DataFrame) -> DataFrame:
    """proc_seq: batch ascending, scan descending, in each capture block (one row per scan)."""
    return blocks(scans).withColumn("proc_seq", F.row_number().over(Window.partitionBy("cb").orderBy("batch", F.desc("scan"))).cast("long"))


def has_any(parts: Sequence[str]) -> Column:
    hit = F.lit(False)
    for p in parts:
        hit = hit | keys.any_tag_like(F.col("tags"), p)
    return hit


def with_scans(vis: DataFrame, scans: DataFrame) -> DataFrame:
    """Visibilities with the scan (t0 to t1) they lie in: an equal join on time bins, then a filter."""
    bins = F.sequence(F.floor(F.col("t0") / BIN_S), F.floor(F.col("t1") / BIN_S))
    spread, own = scans.withColumn("_bin", F.explode(bins)), ["_bin", *(c for c in ("cb",) if c in vis.columns and c in scans.columns)]
    return vis.withColumn("_bin", F.floor(F.col("ts") / BIN_S)).join(spread, own).where("ts >= t0 AND ts <= t1").drop("_bin")


def _last(scans: DataFrame, solved: DataFrame, name: str) -> DataFrame:
    """(scan, name): the scan whose solution each scan uses, by processing order, its own included; scans that are ``old`` use none any more."""
    earlier = F.col("old") if "old" in scans.columns else F.lit(False)
    marked = scans.select("scan", "cb", "proc_seq", earlier.alias("old")).join(solved.select("scan", F.col("scan").alias(name)).distinct(), "scan", "left")
    # One row per scan of the capture block.
    w = Window.partitionBy("cb").orderBy("proc_seq").rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn(name, F.last(name, ignorenulls=True).over(w)).where("NOT old").select("scan", name)


def delay_gains(scans: DataFrame, delays: DataFrame, channels: DataFrame) -> DataFrame:
    """(scan, chan, pol, ant, re, im) of the delays each scan uses."""
    re, im = cplx.delay_phasor(F.col("delay"), F.col("freq_hz"))
    used = _last(scans, delays, "source").where("source IS NOT NULL").join(delays.withColumnRenamed("scan", "source"), "source")
    # Channels are a dimension of the instrument; a row per antenna and channel is what is applied.
    return used.crossJoin(channels.select("chan", "freq_hz")).select("scan", "chan", "pol", "ant", re.alias("re"), im.alias("im"))


def band_gains(scans: DataFrame, delays: DataFrame, bands: DataFrame | None, channels: DataFrame) -> DataFrame:
    """K times B for each scan; a scan without one of them has the other alone."""
    k = delay_gains(scans, delays, channels)
    if bands is None:
        return k
    b = _last(scans, bands, "source").where("source IS NOT NULL").join(bands.withColumnRenamed("scan", "source"), "source")
    b = b.select("scan", "chan", "pol", "ant", F.col("re").alias("br"), F.col("im").alias("bi"))
    both = k.join(b, ["scan", "chan", "pol", "ant"], "full")
    covered = F.max(F.col("br").isNotNull()).over(Window.partitionBy("scan"))
    one = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    # A channel that the scan's bandpass lacks has no gain; a scan without bandpass has K alone.
    br, bi = F.when(F.col("_b"), F.col("br")).otherwise(one("br", 1.0)), F.when(F.col("_b"), F.col("bi")).otherwise(one("bi", 0.0))
    g = cplx.mul((one("re", 1.0), one("im", 0.0)), (br, bi))
    return both.withColumn("_b", covered).select("scan", "chan", "pol", "ant", g[0].alias("re"), g[1].alias("im"))


def _applied(vis: DataFrame, gains: DataFrame, on: Sequence[str], weights: bool) -> DataFrame:
    """``apply_gains`` for the scans that have gains at all; the others as they are (in one pass over the rows)."""
    known = gains.select("scan").distinct().withColumn("_has", F.lit(True))
    cells = {"re": "_re0", "im": "_im0", "weight": "_weight0"}
    rows = vis.join(known, "scan", "left").withColumns({old: F.col(c) for c, old in cells.items()})
    out = apply.apply_gains(rows, gains, on, weights, F.substring("pol", 1, 1), F.substring("pol", -1, 1))
    return out.withColumns({c: F.when(F.col("_has"), F.col(c)).otherwise(F.col(old)) for c, old in cells.items()}).select(*vis.columns)


def _of(rows: DataFrame, scans: DataFrame, tags: Sequence[str]) -> DataFrame:
    return rows.join(scans.where(has_any(tags)).select("scan"), "scan", "left_semi")


def with_intervals(rows: DataFrame, nominal: Column) -> DataFrame:
    """``solint`` of each row: intervals near ``nominal`` dumps (of columns ``_n`` and the scan's own) that divide the scan evenly."""
    # A row per scan; as a table its size is known, and the rows aren't shuffled for it.
    spans = written(rows.groupBy("scan").agg(F.min("dump").alias("_d0"), (F.max("dump") - F.min("dump") + 1).alias("_n")), "spans")
    per = average.solution_interval(F.col("_n"), nominal)
    cut = rows.join(spans, "scan").withColumn("solint", F.floor((F.col("dump") - F.col("_d0")) / per).cast("int"))
    return cut.drop("_d0", "_n")


def interval_gains(rows: DataFrame, nominal: Column, n_ants: int, ref: int, corrected: Callable[[DataFrame], DataFrame] = lambda cut: cut) -> DataFrame:
    """Gains of each scan's intervals: scan, solint, time (mean), pol, ant, re, im, snr; ``corrected`` takes the rows with their interval and divides them first."""
    cut = with_intervals(rows, nominal)
    # Over dumps first, then over channels: partial sums, in one aggregate.
    cells = cut.select("scan", "solint", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight")
    means = average.wavg(corrected(cells), ["scan", "solint", "pol", "ant1", "ant2"]).withColumn("chan", F.lit(0))
    times = cut.groupBy("scan", "solint").agg(F.avg("ts").alias("time"))
    return solve.solve_gains(means, ["scan", "solint"], n_ants, ref).drop("chan").join(times, ["scan", "solint"])


def without_drift(rows: DataFrame, solint: int | None, window: tuple[int, int] | None, n_ants: int, ref: int, sources: DataFrame | None = None, tiles: int = 1) -> DataFrame:
    """Rows divided by preliminary relative gains per ``solint`` dumps, solved on the window (on ``sources`` if given) and interpolated to each dump."""
    if solint is None:
        return rows
    solved = interval_gains((rows if sources is None else sources).where(inside(window)), F.lit(solint), n_ants, ref)
    relative = written(apply.relative_gains(solved, ["scan", "pol", "ant"]).select("scan", F.col("time").alias("ts"), "pol", "ant", "re", "im"), "preliminary")
    return apply.divide_scans(rows, knots=relative, weights=True, tiles=tiles)


def kept(timed: DataFrame, spark: SparkSession | None = None) -> tuple[DataFrame, int]:
    """Rows as a table (of session ``spark``), and the tiles that the channels of the longest scan are dealt to, so that a task holds about ``ROWS`` rows; scans that fit a task stay together."""
    size = timed.groupBy("scan").count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    tiles = max(1, -(-(size["most"] or 0) // ROWS))
    return (together(timed, "rows", "scan", size["all"] or 0, spark) if tiles == 1 else written(timed, "rows", spark)), tiles


def time_averages(rows: DataFrame) -> DataFrame:
    return average.wavg(rows, ["scan", "chan", "pol", "ant1", "ant2"])


def solve_delays(rows: DataFrame, scans: DataFrame, channels: DataFrame, n_ants: int, ref: int, settings: Settings = Settings(), tiles: int = 1) -> DataFrame:
    """K of the delay calibrators, from the dumps of their cross-correlations."""
    s = settings
    chosen = without_drift(_of(rows, scans, DELAY_TAGS).where(inside(s.k_window)), s.k_solint, s.k_window, n_ants, ref, tiles=tiles)
    first = s.k_window[0] if s.k_window else 0
    spectra = time_averages(chosen.where((F.col("chan") - first) % s.k_chan_sample == 0))
    return solve.solve_delays(spectra, channels, ["scan"], n_ants, ref)


def solve_bands(rows: DataFrame, scans: DataFrame, delays: DataFrame, channels: DataFrame, n_ants: int, ref: int, settings: Settings = Settings(), block: int = 64, tiles: int = 1) -> DataFrame:
    """Bandpasses, gaps filled along the band; each antenna's mean over the window is one."""
    s = settings
    k = delay_gains(scans, delays, channels)
    own, straight = _of(rows, scans, BAND_TAGS), lambda x: apply.divide_scans(x, k, weights=True, tiles=tiles)
    if s.bp_solint is None:
        # A delay is the same for all dumps of a scan, so it is taken off their averages.
        averaged = straight(time_averages(own))
    else:
        averaged = time_averages(without_drift(written(straight(own), "straight"), s.bp_solint, s.g_window, n_ants, ref, tiles=tiles))
    flat = written(averaged, "spectra").withColumn("block", F.floor(F.col("chan") / block).cast("int"))
    raw = solve.solve_gains(flat, ["scan", "block"], n_ants, ref).drop("block", "snr")
    flagged = rfi.flag_spectra(raw, ["scan", "pol", "ant"], s.flaggers[0] if s.flaggers else None)
    filled = interp.fill_amp_phase(flagged, ["scan", "pol", "ant"], "chan")
    over = Window.partitionBy("scan", "pol", "ant")
    mean = tuple(F.avg(F.when(inside(s.g_window), F.col(c))).over(over) for c in ("re", "im"))
    re, im = cplx.div(cplx.col(), mean)
    return filled.select("scan", "chan", "pol", "ant", re.alias("re"), im.alias("im"))


def solve_gains(rows: DataFrame, scans: DataFrame, band: DataFrame, n_ants: int, ref: int, settings: Settings = Settings(), tiles: int = 1) -> DataFrame:
    """G per scan and interval: scan, solint, time (mean), pol, ant, re, im, snr."""
    many = F.array_contains("tags", "gaincal") & ~F.array_contains("tags", "bfcal")
    chosen = _of(rows, scans, GAIN_TAGS).join(scans.select("scan", many.alias("_many")), "scan").where(inside(settings.g_window))
    half = F.ceil(F.col("_n") / 2)
    nominal = F.when(F.col("_many"), half if settings.g_solint is None else F.lit(settings.g_solint)).otherwise(F.col("_n"))
    return interval_gains(chosen, nominal, n_ants, ref, lambda cut: apply.divide_scans(cut, band, weights=True, tiles=tiles))


def allowed_gains(scans: DataFrame, gains: DataFrame) -> DataFrame:
    """(scan, ts, pol, ant, re, im): the gains that each scan may use, at the times they were solved for."""
    scans = blocks(scans)
    solved = gains.join(scans.select("scan", "target", "proc_seq", F.col("cb").alias("g_cb")), "scan").drop("scan")
    # Up to the scan's own solutions: those of the same number count.
    wanted = scans.select("scan", "cb", "target", "t0", "t1", (F.col("proc_seq") + 1).alias("proc_seq"))
    allowed = apply.gains_in_window(wanted, solved, WINDOW_S).where("cb = g_cb")
    own = F.max((F.col("g_target") == F.col("target")).cast("int")).over(Window.partitionBy("scan"))
    allowed = allowed.withColumn("_own", own).where((F.col("_own") == 0) | (F.col("g_target") == F.col("target")))
    return written(allowed.select("scan", F.col("time").alias("ts"), "pol", "ant", "re", "im"), "gains")


def gains_at_dumps(dumps: DataFrame, scans: DataFrame, gains: DataFrame) -> DataFrame:
    """(scan, dump, pol, ant, re, im): the gains that each scan may use, interpolated; ``dumps``: scan, dump, ts."""
    allowed = allowed_gains(scans, gains)
    times = dumps.join(allowed.select("scan", "pol", "ant").distinct(), "scan").select("scan", "pol", "ant", "dump", "ts")
    return interp.complex_at_times(allowed, times, ["scan", "pol", "ant"], "ts").select("scan", "dump", "pol", "ant", "re", "im")


def flag_scans(rows: DataFrame, scans: DataFrame, settings: Settings) -> DataFrame:
    """Rows with interference flags, calibrators and targets by their own flagger."""
    cross = F.substring("pol", 1, 1) != F.substring("pol", -1, 1)
    target = scans.select("scan", (F.array_contains("tags", "target") & ~has_any(GAIN_TAGS + DELAY_TAGS)).alias("_target"))
    marked, out = rows.join(target, "scan"), None
    for kind, flagger in zip((False, True), settings.flaggers, strict=True):
        own = marked.where(F.col("_target") == kind).drop("_target")
        keys = ("scan", "pol", "ant1", "ant2")
        if settings.flag_cross:
            found = rfi.flag_interference(own.where(cross), keys, flagger).where(F.col("flags").bitwiseAND(F.lit(rfi.CAL_RFI)) != 0)
            hits = found.select("scan", "dump", "chan", "ant1", "ant2").distinct().withColumn("_hit", F.lit(rfi.CAL_RFI))
            own = own.join(hits, ["scan", "dump", "chan", "ant1", "ant2"], "left").withColumn("flags", F.col("flags").bitwiseOR(F.coalesce("_hit", F.lit(0)))).select(*rows.columns)
        else:
            own = rfi.flag_interference(own, keys, flagger)
        out = own if out is None else out.unionByName(own)
    return out


def reduce_scans(vis: DataFrame, scans: DataFrame, channels: DataFrame, n_ants: int, ref: int, settings: Settings = Settings(), model: DataFrame | None = None, diode: DataFrame | None = None, first: str = "h", earlier: dict[str, DataFrame] | None = None, tiles: int | None = None) -> dict[str, DataFrame]:
    """K, B, G and ``corrected`` of an observation; with ``pointingcal`` scans B_POINTING, with ``polcal`` scans KCROSS and ``cross``, with ``diode`` the products of ``crosshands.solve_diode``.

    ``vis``: ts, dump, chan, pol, ant1, ant2, re, im, flags, weight (and cb, if ``scans`` has it; with a ``scan`` rows aren't sought by
    time); pol is one letter for a parallel hand or two for any hand: the solvers take the parallel ones, all are corrected.
    ``scans``: scan (unique), batch, target, tags, t0, t1 (and cb); ``channels``: chan, freq_hz.  ``model``: dump, chan, ant1, ant2, re, im of the calibrators; cells
    that it lacks stay as they are.  ``diode``: ant, ts, value of the noise diodes; ``first``: the hand that cross-hand products
    are of.  Without four hands there are none of these.  ``earlier``: scans, K, B and G of batches reduced before, which these scans may
    use; nothing of them is reduced or returned again.  ``tiles``: for ``vis`` with a ``scan`` that is a table of ``kept`` already.
    """
    from lodestone.plans import crosshands, pointing

    scans, known = blocks(scans).withColumn("old", F.lit(False)), {"K": [], "B": [], "G": []}
    if earlier is not None:
        scans = scans.unionByName(blocks(earlier["scans"]).withColumn("old", F.lit(True)).select(scans.columns))
        known = {name: [earlier[name]] for name in known}
    scans = written(processing_order(scans), "scans")
    columns = [c for c in vis.columns if c not in ("scan", "cb")]
    timed = (vis if "scan" in vis.columns else with_scans(vis, scans.where("NOT old").select("scan", "cb", "t0", "t1"))).select("scan", *columns)
    if settings.flaggers:
        timed = flag_scans(written(timed, "timed"), scans, settings)
    # Read by every step; the source isn't.
    rows, tiles = (timed, tiles) if tiles is not None and not settings.flaggers else kept(timed)
    hands = crosshands.parallel_rows(rows)
    if model is not None:
        divided = apply.divide_model(hands.join(model.select("dump", "chan", "ant1", "ant2").distinct(), ["dump", "chan", "ant1", "ant2"], "left_semi"), model, ["dump", "chan", "ant1", "ant2"])
        hands = written(divided.unionByName(hands.join(model, ["dump", "chan", "ant1", "ant2"], "left_anti")), "divided")
    k = written(solve_delays(hands, scans, channels, n_ants, ref, settings, tiles), "delays")
    ks = reduce(DataFrame.unionByName, known["K"], k)
    b = written(solve_bands(hands, scans, ks, channels, n_ants, ref, settings, tiles=tiles), "bandpasses")
    band = written(band_gains(scans, ks, reduce(DataFrame.unionByName, known["B"], b), channels), "band")
    g = written(solve_gains(hands, scans, band, n_ants, ref, settings, tiles), "gains")
    allowed = allowed_gains(scans, reduce(DataFrame.unionByName, known["G"], g))
    out = {"K": k, "B": b, "G": g, "corrected": apply.divide_scans(_of(rows, scans, APPLY_TAGS), band, allowed, tiles=tiles)}
    own = scans.where(~F.col("old"))
    if not own.where(has_any((pointing.POINTING_TAG,))).isEmpty():
        out["B_POINTING"] = pointing.solve_pointings(hands, own, n_ants, ref)
    if not scans.where(has_any(crosshands.POL_TAGS) & ~F.col("old")).isEmpty():
        out |= crosshands.solve_polcal(rows, scans, channels, band, n_ants, ref, settings, first, tiles)
    if diode is not None:
        out |= crosshands.solve_diode(rows, scans.where("NOT old"), channels, band, g.drop("solint", "time", "snr"), diode, settings, first)
    return out

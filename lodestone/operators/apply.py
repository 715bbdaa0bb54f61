"""Applying calibration solutions to visibilities, and choosing which ones.

Solutions are a table: product type, (chan), (time), pol, ant, re, im or a delay.  Every
type becomes a complex gain per (antenna, pol[, chan][, time]); a visibility of antennas
a, b is divided by gain_a * conj(gain_b).  Gain tables are far smaller than visibilities
(antennas instead of baselines), and Spark picks broadcast or shuffle by their size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lodestone.functions import cplx
from lodestone.operators.robust import median

#: Types whose value is a delay in seconds.
DELAYS = ("K", "KCROSS", "KCROSS_DIODE")
GAINS = ("G", "B", "BCROSS_DIODE", "BCROSS_DIODE_SKY")


def gain_table(solution: DataFrame, soltype: str, channels: DataFrame | None = None, keys: Sequence[str] = (), ants: DataFrame | None = None) -> DataFrame:
    """Complex gains of a solution per ``keys``; delays are spread over ``channels`` (chan, freq_hz).

    A cross-hand delay is the median of the solution's and goes to ``ants`` (ant and any of the keys; None: the solution's own).
    """
    if soltype in GAINS:
        return solution
    if soltype not in DELAYS:
        raise ValueError(f"unknown solution type {soltype!r}")
    if channels is None:
        raise ValueError("a delay needs the channel frequencies")
    if soltype != "K":  # one delay for all antennas: their median
        ants = solution.select(*keys, "ant").distinct() if ants is None else ants
        shared = [k for k in keys if k in ants.columns]
        middle = solution.groupBy(*keys, "pol").agg(median(F.col("delay")).alias("delay"))
        solution = middle.join(ants, shared) if shared else middle.crossJoin(ants)
    re, im = cplx.delay_phasor(F.col("delay"), F.col("freq_hz"))
    # A row per antenna and channel of the instrument is what is applied.
    return solution.crossJoin(channels.select("chan", "freq_hz")).select(*keys, "ant", "pol", "chan", re.alias("re"), im.alias("im"))


def apply_gains(vis: DataFrame, gains: DataFrame, on: Sequence[str] = (), update_weights: bool = False, pol1: Column | None = None, pol2: Column | None = None) -> DataFrame:
    """Visibilities divided by the gains of both antennas.

    ``on``: further keys of the gain table (chan, time).  ``pol1``, ``pol2``: the gain's
    polarisation for the first and second antenna (by default the visibility's own; for a
    cross hand the second differs).  A missing, zero or NaN gain gives null; with
    ``update_weights`` the weight is multiplied by the squared gain, and zero if it is null.
    """
    first = gains.select("ant", "pol", *on, F.col("re").alias("_g1r"), F.col("im").alias("_g1i"))
    second = gains.select("ant", "pol", *on, F.col("re").alias("_g2r"), F.col("im").alias("_g2i"))
    v = vis.withColumn("_p1", F.col("pol") if pol1 is None else pol1).withColumn("_p2", F.col("pol") if pol2 is None else pol2)
    v = v.join(first.withColumnsRenamed({"ant": "ant1", "pol": "_p1"}), ["ant1", "_p1", *on], "left")
    v = v.join(second.withColumnsRenamed({"ant": "ant2", "pol": "_p2"}), ["ant2", "_p2", *on], "left")
    g = cplx.mul((F.col("_g1r"), F.col("_g1i")), cplx.conj((F.col("_g2r"), F.col("_g2i"))))
    # Step by step: in one expression the gains are written out so often that the JVM doesn't compile the code.
    out = v.withColumns({"_gr": g[0], "_gi": g[1]}).withColumn("_g2", cplx.abs2((F.col("_gr"), F.col("_gi"))))
    out = out.withColumn("_ok", cplx.positive(F.col("_g2")))
    inverse = F.when(F.col("_ok"), F.col("_gr") / F.col("_g2")), F.when(F.col("_ok"), -F.col("_gi") / F.col("_g2"))
    out = out.withColumns({"_ir": inverse[0], "_ii": inverse[1]})
    re, im = cplx.mul(cplx.col(), (F.col("_ir"), F.col("_ii")))
    if update_weights:
        out = out.withColumn("weight", F.when(F.col("_ok"), F.col("weight") * F.col("_g2")).otherwise(F.lit(0.0)))
    out = out.withColumns({"re": re, "im": im})
    return out.select(*vis.columns)


def pre_apply(vis: DataFrame, solutions: Sequence[tuple[str, DataFrame, Sequence[str]]], channels: DataFrame) -> DataFrame:
    """Apply several (type, solution, keys) in turn, with weights."""
    for soltype, solution, on in solutions:
        keys = [*on, "chan"] if soltype in DELAYS and "chan" not in on else list(on)
        vis = apply_gains(vis, gain_table(solution, soltype, channels), keys, True)
    return vis


def relative_gains(gains: DataFrame, keys: Sequence[str] = ("pol", "ant")) -> DataFrame:
    """Gains divided by their mean over time."""
    w = Window.partitionBy(*keys)
    re, im = cplx.clean(F.col("re")), cplx.clean(F.col("im"))
    mean = (F.avg(re).over(w), F.avg(im).over(w))
    out = cplx.div((re, im), mean)
    return gains.withColumn("_r", out[0]).withColumn("_i", out[1]).withColumn("re", F.col("_r")).withColumn("im", F.col("_i")).drop("_r", "_i")


def divide_model(vis: DataFrame, model: DataFrame, on: Sequence[str]) -> DataFrame:
    """Visibilities divided by the model at the same keys (channel, or time, channel, baseline)."""
    m = model.select(*on, F.col("re").alias("_mr"), F.col("im").alias("_mi"))
    re, im = cplx.div(cplx.col(), (F.col("_mr"), F.col("_mi")))
    out = vis.join(m, list(on), "left").withColumn("_r", re).withColumn("_i", im)
    return out.withColumn("re", F.col("_r")).withColumn("im", F.col("_i")).select(*vis.columns)


def gains_in_window(scans: DataFrame, gains: DataFrame, window_s: float = 7200.0, same_target: bool = False) -> DataFrame:
    """Scans with the gain solutions within ``window_s`` of them that were solved before.

    An interval join: times fall into bins of the window's width, each scan asks for the
    bins it touches, so the join is on equal bins (and equal targets, if wanted) and a filter.
    """
    width = F.lit(window_s)
    s = scans.withColumn("_lo", F.col("t0") - width).withColumn("_hi", F.col("t1") + width)
    s = s.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width))))
    g = gains.withColumn("_bin", F.floor(F.col("time") / width)).withColumnRenamed("proc_seq", "g_seq")
    if same_target:
        joined = s.join(g, ["_bin", "target"]).withColumn("g_target", F.col("target"))
    else:
        joined = s.join(g.withColumnRenamed("target", "g_target"), "_bin")
    return joined.where((F.col("time") >= F.col("_lo")) & (F.col("time") <= F.col("_hi")) & (F.col("g_seq") < F.col("proc_seq"))).drop("_bin", "_lo", "_hi")


def latest_solution(scans: DataFrame, solutions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Scans with the last solution solved before them in processing order (any time).

    ``solutions``: keys, proc_seq and ``solution``.
    """
    from lodestone.operators.sensors import asof

    if not keys:
        scans, solutions, keys = scans.withColumn("_all", F.lit(0)), solutions.withColumn("_all", F.lit(0)), ["_all"]
    # A scan doesn't see its own solution: scans come before solutions of the same number.
    shifted = solutions.withColumn("proc_seq", F.col("proc_seq") + 1)
    return asof(scans, shifted, keys, "proc_seq", ["solution"]).drop("_all")


def between(times: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(series, time): complex series (NaN where unknown) at the given times by amplitude and phase, as ``interp.complex_at_times`` has them."""
    out = np.full((len(values), len(at)), np.nan, dtype=complex)
    order = np.argsort(times, kind="stable")
    times, values = times[order], values[:, order]
    alike, kind = np.unique(~np.isnan(values), axis=0, return_inverse=True)
    for k, known in enumerate(alike):
        if not known.any():
            continue
        own = np.flatnonzero(kind.ravel() == k)
        t, z = times[known], values[own][:, known]
        amp, ph = np.abs(z), np.angle(z)
        after = np.searchsorted(t, at, side="right")
        b, a = np.maximum(after - 1, 0), np.minimum(after, len(t) - 1)
        span = t[a] - t[b]
        x = np.divide(at - t[b], span, out=np.zeros(len(at)), where=span != 0)
        turn = ph[:, a] - ph[:, b]
        turn -= 2 * np.pi * np.round(turn / (2 * np.pi))
        out[own] = (amp[:, b] + (amp[:, a] - amp[:, b]) * x) * np.exp(1j * (ph[:, b] + turn * x))
    return out


def _divided(rows: pa.Table, gains: pa.Table, weights: bool) -> pa.Table:
    """Rows of one scan divided by its gains: those with a channel, those with a time, or both."""
    if not rows.num_rows or not gains.num_rows:
        return rows
    chan, ts, ant, re, im = (gains.column(c).to_numpy() for c in ("chan", "ts", "ant", "re", "im"))
    # One letter of a polarisation and one antenna are a series.
    letters, hand = np.unique(np.array(gains.column("pol").fill_null("").to_pylist()), return_inverse=True)
    ants, place = np.unique(ant, return_inverse=True)
    n, code, z = len(letters) * len(ants), hand * len(ants) + place, re + 1j * im
    pols = rows.column("pol").combine_chunks().dictionary_encode()
    names, which = [p or "" for p in pols.dictionary.to_pylist()], pols.indices.fill_null(0).to_numpy()

    def found(values: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Place of each x among the sorted values; their number where it isn't."""
        k = np.searchsorted(values, x)
        return np.where(values[np.minimum(k, len(values) - 1)] == x, k, len(values))

    def series(side: str, letter: list[str]) -> np.ndarray:
        p, a = found(letters, np.array(letter))[which], found(ants, rows.column(side).to_numpy())
        return np.where((p < len(letters)) & (a < len(ants)), p * len(ants) + a, n)

    first, second = series("ant1", [p[:1] for p in names]), series("ant2", [p[-1:] for p in names])
    told = [rows.column(c).to_numpy() for c in ("re", "im", "weight")]
    v, weight, lost = told[0] + 1j * told[1], told[2].astype(float), np.zeros(rows.num_rows, dtype=bool)
    timed = ~np.isnan(ts)
    for some in (~timed, timed):
        if not some.any():
            continue
        if some is timed:
            (times, at), (asked, cell) = np.unique(ts[some], return_inverse=True), np.unique(rows.column("ts").to_numpy(), return_inverse=True)
            known = np.full((n, len(times)), np.nan, dtype=complex)
            known[code[some], at] = z[some]
            table = between(times, known, asked)
        else:
            chans = np.unique(chan[some])
            table = np.full((n, len(chans)), np.nan, dtype=complex)
            table[code[some], np.searchsorted(chans, chan[some])] = z[some]
            cell = found(chans, rows.column("chan").to_numpy())
        table = np.pad(table, ((0, 1), (0, 1)), constant_values=np.nan)
        g = table[first, cell] * table[second, cell].conj()
        size = g.real**2 + g.imag**2
        ok = size > 0
        v = v * np.divide(g.conj(), size, out=np.zeros(len(g), dtype=complex), where=ok)
        weight = np.where(ok, weight * size, 0.0)
        lost |= ~ok
    made = {"re": (v.real, lost), "im": (v.imag, lost)} | ({"weight": (np.where(lost, 0.0, weight), False)} if weights else {})
    for c, (x, gone) in made.items():
        null = gone | rows.column(c).is_null().to_numpy()
        rows = rows.set_column(rows.column_names.index(c), c, pa.array(x, mask=null))
    return rows


def divide_scans(vis: DataFrame, band: DataFrame | None = None, knots: DataFrame | None = None, weights: bool = False, tiles: int = 1) -> DataFrame:
    """Visibilities divided, scan by scan, by the gains of both antennas: ``band`` (scan, chan, pol, ant, re, im), ``knots``
    (scan, ts, pol, ant, re, im), between which gains are interpolated, or both.

    A visibility's hand gives the polarisations of both antennas.  A scan without gains of a kind goes on without it; in one that has
    them a missing, zero or NaN gain gives null, and with ``weights`` the weight is multiplied by the squared gain, and zero if it is null.
    Rows and gains meet once, by scan, and no gain is made for a dump that isn't looked at; where a scan is too long for a task
    its channels are dealt to ``tiles``.
    """
    tile = F.pmod(F.hash("chan"), F.lit(tiles))
    spread = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    scan, parts = F.col("scan").cast(vis.schema["scan"].dataType).alias("scan"), []
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    value = [F.col(c).cast("double").alias(c) for c in ("re", "im")]
    if band is not None:
        parts.append(band.select(scan, F.col("chan").cast("double").alias("chan"), none("ts", "double"), "pol", "ant", *value, tile.alias("_tile")))
        if tiles > 1:
            # A mark for the tiles whose channels have no gain though the scan has some.
            parts.append(band.select(scan).distinct().select("scan", F.lit(-1.0).alias("chan"), none("ts", "double"), F.lit("").alias("pol"), F.lit(-1).alias("ant"), none("re", "double"), none("im", "double"), spread.alias("_tile")))
    if knots is not None:
        parts.append(knots.select(scan, none("chan", "double"), F.col("ts").cast("double").alias("ts"), "pol", "ant", *value, spread.alias("_tile")))
    gains = parts[0]
    for part in parts[1:]:
        gains = gains.unionByName(part)
    names = vis.columns
    made = {"re", "im", "weight"} if weights else {"re", "im"}
    schema = StructType([StructField(f.name, DoubleType()) if f.name in made else f for f in vis.schema])

    def step(rows: pa.Table, own: pa.Table) -> pa.Table:
        out = _divided(rows.select(names), own, weights)
        return out if rows.num_rows and own.num_rows else out.cast(pa.schema([pa.field(f.name, pa.float64()) if f.name in made else f for f in out.schema]))

    keys = ["scan"] if tiles == 1 else ["scan", "_tile"]
    return (vis if tiles == 1 else vis.withColumn("_tile", tile)).groupBy(*keys).cogroup(gains.groupBy(*keys)).applyInArrow(step, schema)

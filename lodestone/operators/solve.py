"""Solvers: gains, bandpass, delays and cross-hand phases.

The heavy data are averaged first with SQL aggregates; what reaches a solver is one group
per (interval, polarisation[, channel block]), which is small, and is solved with numpy.

* gains: alternating least squares per antenna (Salvini and Wijnholds 2014), with the even
  steps averaged, phases referred to the reference antenna;
* delays: the peak of the zero-padded delay transform, refined by a parabola;
* baseline data are ``vis`` = gain1 * conj(gain2) * model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells that a solver holds as arrays at once.
CELLS = 1 << 18
GAIN_SCHEMA = "chan int, pol string, ant int, re double, im double, snr double"


def stefcal(vis: np.ndarray, weight: np.ndarray, ant1: np.ndarray, ant2: np.ndarray, n_ants: int, ref: int, iterations: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Gains (n_ants, ...) of unit-model visibilities (baselines, ...); NaN where unconstrained."""
    shape = vis.shape[1:]
    v, w = vis.reshape(len(vis), -1), weight.reshape(len(vis), -1)
    n = v.shape[1]
    column, bl = np.tile(np.arange(n), len(v)), np.repeat(np.arange(len(v)), n)
    return alternating(v.ravel(), w.ravel(), column, ant1[bl], ant2[bl], n, n_ants, ref, iterations, tolerance).T.reshape(n_ants, *shape)


def alternating(v: np.ndarray, w: np.ndarray, column: np.ndarray, ant1: np.ndarray, ant2: np.ndarray, n: int, n_ants: int, ref: int, iterations: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Gains (n, n_ants) of n independent problems; a cell is a visibility of one of them (``column``)."""
    w = np.where(np.isfinite(v) & (w > 0), w, 0.0)
    v = np.where(w > 0, v, 0)
    place = (column * n_ants + ant1) * n_ants + ant2, (column * n_ants + ant2) * n_ants + ant1
    size = n * n_ants * n_ants
    total = lambda at, x: np.bincount(at, x, size).reshape(n, n_ants, n_ants)
    fw = sum(total(p, w) for p in place)
    full = total(place[0], w * v.real) + total(place[1], w * v.real) + 1j * (total(place[0], w * v.imag) - total(place[1], w * v.imag))
    weights, sums = np.bincount(column, w, n), np.bincount(column, w * np.abs(v), n)
    scale = np.sqrt(np.where(weights > 0, sums / np.maximum(weights, 1e-300), 1.0))
    scale[scale == 0] = 1.0
    g = np.ones((n, n_ants), dtype=complex) * scale[:, None]
    left, s, d, now = np.arange(n), full, fw, g.copy()
    for k in range(iterations):
        # Each antenna against all others: sum w v g / sum w |g|^2.
        num = (s @ now[:, :, None])[:, :, 0]
        den = (d @ (np.abs(now) ** 2)[:, :, None])[:, :, 0]
        new = np.divide(num, den, out=np.zeros_like(num), where=den > 0)
        if k % 2:
            new = (new + now) / 2
        moved = np.abs(new - now).max(axis=1, initial=0) / np.maximum(np.abs(new).max(axis=1, initial=0), 1e-300)
        now = g[left] = new
        going = moved >= tolerance
        if not going.any():
            break
        if going.mean() < 0.7:  # the rest is solved
            left, s, d, now = left[going], s[going], d[going], now[going]
    g = np.where(fw.sum(axis=2) > 0, g, np.nan)
    with np.errstate(all="ignore"):
        turn = g[:, ref] / np.abs(g[:, ref])
    return g * np.where(np.isfinite(turn), turn, 1).conj()[:, None]


def solve_gains(vis: DataFrame, keys: list[str], n_ants: int, ref: int) -> DataFrame:
    """Gain per key, channel, pol and antenna, from averaged cross-correlation rows.

    Rows: keys, chan, pol, ant1, ant2, re, im, flags, weight; ``keys`` may hold the solution
    interval and channel block.  The SNR of a key and antenna is one over the weighted rms of its corrected
    baselines about one.  A row of the step is one key's cells; a task solves many of them in the same arrays.
    """
    names = [*keys, "pol"]
    columns = [*keys, "chan", "pol", "ant", "re", "im", "snr"]

    def some(owner: np.ndarray, chan: np.ndarray, a1: np.ndarray, a2: np.ndarray, v: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Owner, channel, antenna, gain and SNR of the cells of n keys."""
        both, column = np.unique(np.stack([owner, chan]), axis=1, return_inverse=True)
        column = column.ravel()
        g = alternating(v, w, column, a1, a2, both.shape[1], n_ants, ref)
        with np.errstate(all="ignore"):
            resid = v / (g[column, a1] * g[column, a2].conj()) - 1
        own = np.where(np.isfinite(resid) & (w > 0), w, 0.0)
        sq = own * np.abs(np.nan_to_num(resid)) ** 2
        total, squares = (sum(np.bincount(owner * n_ants + a, x, n * n_ants) for a in (a1, a2)) for x in (own, sq))
        with np.errstate(all="ignore"):
            snr = np.where(total > 0, 1 / np.maximum(np.sqrt(squares / total), 1e-12), np.nan)
        who, ant = np.repeat(both[0], n_ants), np.tile(np.arange(n_ants), both.shape[1])
        return who, np.repeat(both[1], n_ants), ant, g.ravel(), snr[who * n_ants + ant]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        null = lambda x: pa.array(x, mask=np.isnan(x))
        for batch in batches:
            sizes = np.asarray(batch.column("cells").value_lengths())
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes):
                # As many keys as fit, one at least; a key has at most its cells' number of channels.
                start = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, start + max(1, 16 * CELLS // n_ants**2), side="right")))
                part = batch.slice(first, last - first)
                flat = part.column("cells").flatten()
                chan, a1, a2 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("chan", "ant1", "ant2"))
                re, im, w = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("re", "im", "weight"))
                who, chans, ant, g, snr = some(np.repeat(np.arange(last - first), sizes[first:last]), chan, a1, a2, re + 1j * im, np.nan_to_num(w), last - first)
                kept = {k: part.column(k).take(pa.array(who)) for k in names}
                made = {"chan": pa.array(chans.astype(np.int32)), "ant": pa.array(ant.astype(np.int32)), "re": null(g.real), "im": null(g.imag), "snr": null(snr)}
                yield pa.RecordBatch.from_arrays([(kept | made)[c] for c in columns], columns)
                first = last

    kinds = "".join(f"`{k}` {vis.schema[k].dataType.simpleString()}, " for k in keys)
    weight = F.when(F.col("flags") == 0, F.col("weight")).otherwise(0.0).cast("double").alias("weight")
    cell = F.struct(F.col("chan").cast("int").alias("chan"), F.col("ant1").cast("int").alias("ant1"), F.col("ant2").cast("int").alias("ant2"), F.col("re").cast("double").alias("re"), F.col("im").cast("double").alias("im"), weight)
    cells = vis.where("ant1 <> ant2").groupBy(*names).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return cells.mapInArrow(solve, kinds + GAIN_SCHEMA)


def grid_step(freq: np.ndarray) -> float:
    """The widest step of which all distances between the frequencies are multiples (to a thousandth); the least distance where there is none."""
    apart = np.diff(np.sort(freq))
    apart = apart[apart > 0]
    if not len(apart):
        return 0.0
    least = float(apart.min())
    whole = lambda step: (np.abs(apart / step - np.round(apart / step)) < 1e-3).all()
    return next((least / k for k in range(1, 17) if whole(least / k)), least)


def delay_of(spectrum: np.ndarray, weight: np.ndarray, freq: np.ndarray, pad: int = 8) -> float:
    """Delay (s) of a phase slope: that of ``alike_delays``, on the channels with a value and weight."""
    ok = np.isfinite(spectrum) & (weight > 0)
    return float(alike_delays((spectrum * weight)[ok][None], freq[ok], pad)[0])


def alike_delays(x: np.ndarray, freq: np.ndarray, pad: int = 8) -> np.ndarray:
    """Delays of weighted spectra (spectrum, channel) on the same channels: peaks of the padded transform, each refined by a weighted phase fit; the most coherent stands.

    Channels stand at their place on the frequency grid, whichever are missing.  Delays that the channels cannot
    tell apart (one over their ``grid_step``) give the one nearest to zero; fewer than two channels give none.
    """
    step = grid_step(freq)
    if not step:
        return np.full(len(x), np.nan)
    place = np.round((freq - freq.min()) / step).astype(int)
    grid = np.zeros((len(x), place.max() + 1), dtype=complex)
    np.add.at(grid, (slice(None), place), x)
    n = pad * grid.shape[1]
    power = np.abs(np.fft.ifft(grid, n, axis=1))
    before, after = np.roll(power, 1, axis=1), np.roll(power, -1, axis=1)
    # A peak between two bins is at most a few hundredths above them.
    row, k = np.nonzero((power >= before) & (power >= after) & (power >= 0.9 * power.max(axis=1, keepdims=True)))
    a, b, c = before[row, k], power[row, k], after[row, k]
    bend = a - 2 * b + c
    offset = np.divide(0.5 * (a - c), bend, out=np.zeros_like(bend), where=bend != 0)
    # Transform sign: x ~ exp(2 pi i delay f) peaks at -delay.
    delay = -((k + offset + n / 2) % n - n / 2) / (n * step)
    z, f = x[row], freq - freq.mean()
    size = np.abs(z)
    with np.errstate(all="ignore"):
        fw = f - (size * f).sum(axis=1, keepdims=True) / size.sum(axis=1, keepdims=True)
        spread = (size * fw * fw).sum(axis=1) * 2 * np.pi
        for _ in range(3):
            rest = z * np.exp(-2j * np.pi * delay[:, None] * f)
            delay = delay + (size * fw * np.angle(rest * np.conj(rest.sum(axis=1, keepdims=True)))).sum(axis=1) / spread
    coherent = np.abs((z * np.exp(-2j * np.pi * delay[:, None] * f)).sum(axis=1))
    most = np.zeros(len(x))
    np.maximum.at(most, row, np.nan_to_num(coherent))
    near = np.where(coherent >= most[row] * (1 - 1e-9), np.abs(delay), np.inf)
    least = np.full(len(x), np.inf)
    np.minimum.at(least, row, near)
    out = np.full(len(x), np.nan)
    chosen = np.isfinite(near) & (near == least[row])
    out[row[chosen]] = delay[chosen]
    return out


def _antenna_delays(a1: np.ndarray, a2: np.ndarray, delay: np.ndarray, n_ants: int, ref: int) -> np.ndarray:
    """Least-squares delays of the antennas, zero for the reference."""
    design, rows = np.zeros((len(delay), n_ants)), np.arange(len(delay))
    design[rows, a1] += 1
    design[rows, a2] -= 1
    sol = np.zeros(n_ants)
    sol[np.arange(n_ants) != ref] = np.linalg.lstsq(np.delete(design, ref, axis=1), delay, rcond=None)[0]
    return sol


def unwrapped(a1: np.ndarray, a2: np.ndarray, delay: np.ndarray, period: np.ndarray, n_ants: int, ref: int) -> np.ndarray:
    """Delays of baselines whose channels leave them open by a period, turned to what baselines with a wider one say."""
    ok = np.isfinite(delay) & np.isfinite(period)
    sure = ok & (period >= 0.999 * period[ok].max(initial=0))
    if sure.all() or not (ok & ~sure).any():
        return delay
    # Antennas that the sure baselines tie to each other.
    group = np.arange(n_ants)
    for a, b in zip(a1[sure], a2[sure], strict=True):
        group[group == group[a]] = group[b]
    sol = _antenna_delays(a1[sure], a2[sure], delay[sure], n_ants, ref)
    tied = ok & ~sure & (group[a1] == group[a2])
    out = delay.copy()
    out[tied] += np.round((sol[a1] - sol[a2] - delay)[tied] / period[tied]) * period[tied]
    return out


def solve_delays(vis: DataFrame, channels: DataFrame, keys: list[str], n_ants: int, ref: int) -> DataFrame:
    """Delay per key, pol and antenna relative to the reference, from time-averaged rows.

    A row of the first step is one baseline's spectrum, a row of the second the baselines' delays of a
    key and polarisation; the SNR is one over the weighted rms of the residual phasors about one.
    """
    kinds = "".join(f"`{k}` {vis.schema[k].dataType.simpleString()}, " for k in keys)
    names = [*keys, "pol", "ant1", "ant2"]

    def alike(v: np.ndarray, weight: np.ndarray, freq: np.ndarray) -> np.ndarray:
        """(spectrum, 4): delay, period, weight and squared residuals of spectra on the same channels."""
        x = v * weight
        delay, step = alike_delays(x, freq), grid_step(freq)
        with np.errstate(all="ignore"):
            flat = v * np.exp(-2j * np.pi * delay[:, None] * freq)
            mean = (flat * weight).sum(axis=1, keepdims=True)
            unit = flat * np.conj(mean) / np.abs(flat * mean)
        sq = np.where(np.isfinite(unit), weight * np.abs(np.nan_to_num(unit) - 1) ** 2, 0.0).sum(axis=1)
        return np.stack([delay, np.full(len(v), 1 / step if step else np.nan), weight.sum(axis=1), sq], axis=1)

    def baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spectrum")
            flat, ends = lists.flatten(), np.cumsum(np.asarray(lists.value_lengths()))
            freq, re, im, weight = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("freq_hz", "re", "im", "weight"))
            v, found = re + 1j * im, np.full((len(lists), 4), np.nan)
            ok = np.isfinite(v) & (weight > 0)
            kinds: dict[bytes, list[np.ndarray]] = {}
            rows: dict[bytes, list[int]] = {}
            for k, own in enumerate(np.split(np.arange(len(v)), ends[:-1])):
                own = own[ok[own]]
                seen = freq[own].tobytes()
                kinds.setdefault(seen, []).append(own)
                rows.setdefault(seen, []).append(k)
            for seen, own in kinds.items():
                at, to = np.stack(own), np.array(rows[seen])
                size = max(1, CELLS // max(1, at.shape[1]))
                for k in range(0, len(at), size):
                    found[to[k : k + size]] = alike(v[at[k : k + size]], weight[at[k : k + size]], freq[at[0]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(x) for x in found.T)], [*names, "delay", "period", "w", "sq"])

    def antennas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Weighted least squares with the reference at zero.
        for batch in batches:
            lists = batch.column("cells")
            flat, ends = lists.flatten(), np.cumsum(np.asarray(lists.value_lengths()))
            told = [flat.field(c).to_numpy(zero_copy_only=False) for c in ("ant1", "ant2", "delay", "period", "w", "sq")]
            found = np.full((2, len(lists), n_ants), np.nan)
            for k, (a1, a2, delay, period, w, sq) in enumerate(zip(*(np.split(x, ends[:-1]) for x in told), strict=True)):
                delay = unwrapped(a1, a2, delay, period, n_ants, ref)
                ok = np.isfinite(delay)
                if ok.any():
                    sol = _antenna_delays(a1[ok], a2[ok], delay[ok], n_ants, ref)
                    both = np.concatenate([a1[ok], a2[ok]])
                    seen = np.bincount(both, minlength=n_ants) > 0
                    sol[ref], sol[~seen] = 0.0, np.nan
                    squares, total = (np.bincount(both, np.tile(x[ok], 2), n_ants) for x in (sq, w))
                    with np.errstate(all="ignore"):
                        found[:, k] = sol, np.where(seen, 1 / np.maximum(np.sqrt(squares / total), 1e-12), np.nan)
            who = pa.array(np.repeat(np.arange(len(lists)), n_ants))
            kept = [batch.column(c).take(who) for c in (*keys, "pol")]
            delay, snr = (pa.array(x.ravel(), mask=np.isnan(x.ravel())) for x in found)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.tile(np.arange(n_ants, dtype=np.int32), len(lists))), delay, snr], [*keys, "pol", "ant", "delay", "snr"])

    # Channels are a dimension of the instrument: Spark broadcasts them where they are few.
    weight = F.when((F.col("flags") == 0) & F.col("re").isNotNull() & F.col("im").isNotNull(), F.col("weight")).otherwise(0.0)
    cross = vis.where("ant1 <> ant2").join(channels.select("chan", "freq_hz"), "chan")
    cell = F.struct("freq_hz", F.col("re").cast("double").alias("re"), F.col("im").cast("double").alias("im"), weight.cast("double").alias("weight"))
    rows = cross.groupBy(*names).agg(F.array_sort(F.collect_list(cell)).alias("spectrum"))
    spectra = rows.mapInArrow(baselines, f"{kinds}pol string, ant1 int, ant2 int, delay double, period double, w double, sq double")
    cells = spectra.groupBy(*keys, "pol").agg(F.array_sort(F.collect_list(F.struct("ant1", "ant2", "delay", "period", "w", "sq"))).alias("cells"))
    return cells.mapInArrow(antennas, f"{kinds}pol string, ant int, delay double, snr double")


def solve_cross_delay(combined: DataFrame, channels: DataFrame, keys: list[str], pol: str) -> DataFrame:
    """Delay per key of combined cross-hand spectra (re, im, weight by channel); the other pol is zero."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("freq_hz")
        d = delay_of((pdf.re + 1j * pdf.im).to_numpy(), pdf.weight.to_numpy(), pdf.freq_hz.to_numpy())
        return pd.DataFrame({k: [pdf[k].iloc[0]] for k in keys} | {"pol": [pol], "delay": [d]})

    kinds = "".join(f"`{k}` {combined.schema[k].dataType.simpleString()}, " for k in keys)
    rows = combined.join(channels.select("chan", "freq_hz"), "chan").select(*keys, "freq_hz", "re", "im", "weight")
    return rows.groupBy(*keys).applyInPandas(solve, f"{kinds}pol string, delay double")


def cross_phase(combined: DataFrame) -> DataFrame:
    """Unit-modulus phase of combined cross hands; exact zeros have no phase."""
    amp = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    some = amp > 0
    return combined.withColumn("_a", amp).withColumn("re", F.when(some, F.col("re") / F.col("_a"))).withColumn("im", F.when(some, F.col("im") / F.col("_a"))).drop("_a")


def spline(x: np.ndarray, knots: np.ndarray, coefs: np.ndarray, degree: int) -> np.ndarray:
    """B-spline values by de Boor's recursion (ends extended)."""
    k = np.clip(np.searchsorted(knots, x, side="right") - 1, degree, len(knots) - degree - 2)
    d = [np.asarray(coefs, dtype=float)[j + k - degree] for j in range(degree + 1)]
    for r in range(1, degree + 1):
        for j in range(degree, r - 1, -1):
            lo, span = knots[j + k - degree], knots[j + 1 + k - r] - knots[j + k - degree]
            a = np.divide(x - lo, span, out=np.zeros(len(x)), where=span != 0)
            d[j] = (1 - a) * d[j - 1] + a * d[j]
    return d[degree]


def rotate_by_spline(solution: DataFrame, knots: list[float], coefs: list[float], degree: int, conjugate: bool) -> DataFrame:
    """Phases turned by a spline of the frequency in MHz (degrees); rows: freq_hz, re, im."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            turn = np.exp(1j * np.radians(spline(pdf.freq_hz.to_numpy() / 1e6, np.array(knots), np.array(coefs), degree)))
            z = (pdf.re + 1j * pdf.im).to_numpy() * (turn.conj() if conjugate else turn)
            yield pdf.assign(re=z.real, im=z.imag)

    return solution.mapInPandas(run, solution.schema)


def reference_antenna(vis: DataFrame, previous: int | None = None, most_flagged: float = 0.8) -> DataFrame:
    """One row: the chosen antenna.

    The previous one stays if less than ``most_flagged`` of its cells are flagged; else the
    antenna with the highest ratio of coherent to rms amplitude over its baselines.
    """
    from lodestone.operators.average import per_antenna

    ants = per_antenna(vis.where("ant1 <> ant2"))
    good = (F.col("flags") == 0).cast("double")
    by_bl = ants.groupBy("ant", "pol", "ant1", "ant2").agg(
        F.avg(1 - good).alias("flagged"), F.avg(F.when(F.col("flags") == 0, F.col("re"))).alias("mr"), F.avg(F.when(F.col("flags") == 0, F.col("im"))).alias("mi"),
        F.avg(F.when(F.col("flags") == 0, F.col("re") ** 2 + F.col("im") ** 2)).alias("power"),
    )
    quality = by_bl.groupBy("ant").agg(F.avg("flagged").alias("flagged"), F.avg((F.col("mr") ** 2 + F.col("mi") ** 2) / F.col("power")).alias("quality"))
    keep = (F.col("ant") == F.lit(previous)) & (F.col("flagged") < most_flagged) if previous is not None else F.lit(False)
    excluded = (F.col("ant") == F.lit(previous)) & (F.col("flagged") >= most_flagged) if previous is not None else F.lit(False)
    return quality.orderBy(F.desc(keep), excluded, F.desc_nulls_last("quality"), "ant").limit(1).select("ant")


def delay_peaks(vis: DataFrame, channels: DataFrame, pad: int = 8) -> DataFrame:
    """(pol, ant1, ant2, peak, flagged) per baseline: the peak of its padded delay transform over the transform's median.

    Spectra are averaged over time first; a row is one baseline's spectrum.  A delay moves the peak and
    leaves its height, so an antenna with a large one is as good as any other.
    """
    from lodestone.operators.average import partial_sums

    names = ["pol", "ant1", "ant2"]
    sums = partial_sums(vis.where("ant1 <> ant2"), [*names, "chan"]).join(channels.select("chan", "freq_hz"), "chan")
    cell = F.struct("freq_hz", F.coalesce(F.col("swr") / F.col("sw"), F.lit(0.0)).alias("re"), F.coalesce(F.col("swi") / F.col("sw"), F.lit(0.0)).alias("im"))
    rows = sums.groupBy(*names).agg(F.array_sort(F.collect_list(cell)).alias("spectrum"), (F.sum("n_flagged") / F.sum("n")).alias("flagged"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spectrum")
            flat, sizes = lists.flatten(), np.asarray(lists.value_lengths())
            z = np.asarray(flat.field("re")) + 1j * np.asarray(flat.field("im"))
            found = np.zeros(len(sizes))
            for k, part in enumerate(np.split(z, np.cumsum(sizes)[:-1])):
                size = np.abs(np.fft.fft(part, pad * len(part)))
                found[k] = size.max() / middle if (middle := np.median(size)) > 0 else 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found), batch.column("flagged")], [*names, "peak", "flagged"])

    return rows.mapInArrow(run, "pol string, ant1 int, ant2 int, peak double, flagged double")


def antenna_ranking(vis: DataFrame, channels: DataFrame, most_flagged: float = 0.8, previous: int | None = None) -> DataFrame:
    """(ant, quality, flagged, place): antennas from the best reference on, by the mean peak of their baselines.

    Antennas with ``most_flagged`` of their cells flagged come last; the previous reference stays first unless it is one of them.
    """
    ends = F.explode(F.array("ant1", "ant2")).alias("ant")
    by_ant = delay_peaks(vis, channels).select(ends, "peak", "flagged").groupBy("ant").agg(F.avg("peak").alias("quality"), F.avg("flagged").alias("flagged"))
    last = F.col("flagged") >= most_flagged
    kept = (F.col("ant") == F.lit(previous)) & ~last if previous is not None else F.lit(False)
    # One row per antenna.
    place = F.row_number().over(Window.orderBy(F.desc(kept), last, F.desc("quality"), "ant"))
    return by_ant.withColumn("place", place)


def residuals(vis: DataFrame, gains: DataFrame, on: list[str]) -> DataFrame:
    """Corrected visibilities less one."""
    from lodestone.operators.apply import apply_gains

    return apply_gains(vis, gains, on).withColumn("re", F.col("re") - 1)


def poor_antennas(resid: DataFrame, keys: list[str], limit: float = 0.2) -> DataFrame:
    """Per key and antenna: weighted rms residual over its baselines, and whether it is above the limit.

    Flagged and missing cells don't count; an antenna without any is poor.
    """
    from lodestone.operators.average import per_antenna

    w = F.when((F.col("flags") == 0) & F.col("re").isNotNull(), F.col("weight"))
    rms = F.sqrt(F.sum(w * (F.col("re") ** 2 + F.col("im") ** 2)) / F.sum(w))
    return per_antenna(resid).groupBy(*keys, "ant").agg(rms.alias("rms")).withColumn("poor", F.coalesce(F.col("rms") > limit, F.lit(True)))

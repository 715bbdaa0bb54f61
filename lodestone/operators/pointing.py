"""Pointing: offsets of a reference antenna, and Gaussian beams fitted to gains at offsets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import keys as funcs

BEAM = "ant int, chunk int, pol string, x0 double, y0 double, wx double, wy double, height double, valid boolean, x0_err double, y0_err double, wx_err double, wy_err double, height_err double"


#: Points of beams that a fit holds as arrays at once.
CELLS = 1 << 16


def fit_beam(x: np.ndarray, y: np.ndarray, amp: np.ndarray, weight: np.ndarray | None = None, iterations: int = 50) -> tuple[np.ndarray, np.ndarray, bool]:
    """``fit_beams`` of one beam."""
    w = np.ones(len(amp)) if weight is None else weight
    p, error, valid = fit_beams(x[None], y[None], amp[None], w[None], weight is None, iterations)
    return p[0], error[0], bool(valid[0])


def fit_beams(x: np.ndarray, y: np.ndarray, amp: np.ndarray, weight: np.ndarray, unknown: bool, iterations: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x0, y0, wx, wy, height) of height * exp(-((x-x0)/wx)^2 / 2 - ...) by weighted Gauss-Newton, their errors, and whether the fit is valid; arrays are (beam, point).

    ``weight``: one over each amplitude's variance (zero: no point); if it is ``unknown`` all count alike, and the errors follow from the
    scatter about the fit (nothing is left of it with five points: their errors are unknown).  A fit is valid if it
    has positive widths and its centre is known to less than a width.
    """
    n = len(amp)
    params, errors, valid = np.full((n, 5), np.nan), np.full((n, 5), np.nan), np.zeros(n, dtype=bool)
    root = np.sqrt(np.where(np.isfinite(weight) & (weight > 0), weight, 0.0))
    ok = np.isfinite(amp) & (amp > 0) & (root > 0) & np.isfinite(x) & np.isfinite(y)
    # Points that don't count are rows of zeros.
    x, y, a, root = (np.where(ok, z, v) for z, v in ((x, 0.0), (y, 0.0), (amp, 1.0), (root, 0.0)))
    count = ok.sum(axis=1)
    left = np.flatnonzero(count >= 5)
    if not len(left):
        return params, errors, valid
    x, y, a, root, count = x[left], y[left], a[left], root[left], count[left]

    def solved(design: np.ndarray, target: np.ndarray) -> np.ndarray:
        with_rank = np.finfo(float).eps * max(design.shape[1:])
        return (np.linalg.pinv(design, rcond=with_rank) @ target[:, :, None])[:, :, 0]

    # The log of a Gaussian is a quadratic: c0 + c1 x + c2 y + c3 x^2 + c4 y^2.
    design = np.stack([np.ones_like(x), x, y, x * x, y * y], axis=2) * (a * root)[:, :, None]
    c = solved(design, np.log(a) * a * root)
    some = (c[:, 3] < 0) & (c[:, 4] < 0)
    left, c, x, y, a, root, count = (z[some] for z in (left, c, x, y, a, root, count))
    if not len(left):
        return params, errors, valid
    p = np.stack([-c[:, 1] / (2 * c[:, 3]), -c[:, 2] / (2 * c[:, 4]), np.sqrt(-0.5 / c[:, 3]), np.sqrt(-0.5 / c[:, 4]), np.zeros(len(c))], axis=1)
    with np.errstate(all="ignore"):
        p[:, 4] = np.exp(c[:, 0] - c[:, 3] * p[:, 0] ** 2 - c[:, 4] * p[:, 1] ** 2)

    def model(at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x0, y0, wx, wy, height = (q[:, None] for q in of.T)
        dx, dy = (x[at] - x0) / wx, (y[at] - y0) / wy
        f = height * np.exp(-0.5 * (dx**2 + dy**2))
        return f, np.stack([f * dx / wx, f * dy / wy, f * dx**2 / wx, f * dy**2 / wy, f / height], axis=2)

    going = np.flatnonzero(np.isfinite(p).all(axis=1))
    with np.errstate(all="ignore"):
        for _ in range(iterations):
            f, jac = model(going, p[going])
            jac = jac * root[going][:, :, None]
            sane = np.isfinite(jac).all(axis=(1, 2))
            p[going[~sane]] = np.nan
            going, f, jac = going[sane], f[sane], jac[sane]
            if not len(going):
                break
            step = solved(jac, (a[going] - f) * root[going])
            p[going] += step
            going = going[np.abs(step).max(axis=1) >= 1e-12 * np.maximum(1.0, np.abs(p[going]).max(axis=1))]
            if not len(going):
                break
        params[left] = p
        good = np.flatnonzero(np.isfinite(p).all(axis=1) & (p[:, 2] > 0) & (p[:, 3] > 0))
        f, jac = model(good, p[good])
        jac = jac * root[good][:, :, None]
        sane = np.isfinite(jac).all(axis=(1, 2))
        good, f, jac = good[sane], f[sane], jac[sane]
        variance = np.diagonal(np.linalg.pinv(np.swapaxes(jac, 1, 2) @ jac), axis1=1, axis2=2) if len(good) else np.zeros((0, 5))
        if unknown:
            variance = variance * ((np.where(root[good] > 0, a[good] - f, 0.0) ** 2).sum(axis=1) / (count[good] - 5))[:, None]
        error = np.sqrt(variance)
    errors[left[good]] = error
    valid[left[good]] = ~((error[:, 0] >= p[good, 2]) | (error[:, 1] >= p[good, 3]))
    return params, errors, valid


def beam_fits(gains: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Beam per antenna, frequency chunk and pol (and ``keys``); rows: ant, chunk, pol, x, y (degrees), amp and, if known, weight (one over its variance).

    A row of the step is one beam's points; a task fits many beams in the same arrays.
    """
    own, unknown = [*keys, "ant", "chunk", "pol"], "weight" not in gains.columns
    values = [c.split()[0] for c in BEAM.split(", ")][3:]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("points").value_lengths())
            flat = batch.column("points").flatten()
            start = np.cumsum(sizes) - sizes
            x, y, amp, weight = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y", "amp", "weight"))
            params, errors, valid = np.full((len(sizes), 5), np.nan), np.full((len(sizes), 5), np.nan), np.zeros(len(sizes), dtype=bool)
            # Beams of like size together, so that little is padded.
            order, k = np.argsort(sizes, kind="stable"), 0
            while k < len(order):
                width = int(sizes[order[min(len(order) - 1, k + max(1, CELLS // max(1, int(sizes[order[k]]))) - 1)]])
                some = order[k : k + max(1, CELLS // max(1, width))]
                k += len(some)
                width = int(sizes[some].max())
                at = start[some][:, None] + np.arange(width)
                inside = np.arange(width) < sizes[some][:, None]
                at = np.where(inside, at, 0)
                if width:
                    params[some], errors[some], valid[some] = fit_beams(x[at], y[at], amp[at], np.where(inside, weight[at], 0.0), unknown)
            null = lambda z: pa.array(z, mask=np.isnan(z))
            found = [*(null(z) for z in params.T), pa.array(valid), *(null(z) for z in errors.T)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *found], [*own, *values])

    weight = F.lit(1.0) if unknown else F.col("weight").cast("double")
    points = F.collect_list(F.struct(*(F.col(c).cast("double").alias(c) for c in ("x", "y", "amp")), weight.alias("weight")))
    kinds = "".join(f"{k} {gains.schema[k].dataType.simpleString()}, " for k in keys)
    typed = gains.withColumns({"ant": F.col("ant").cast("int"), "chunk": F.col("chunk").cast("int")})
    return typed.groupBy(*own).agg(F.array_sort(points).alias("points")).mapInArrow(fit, kinds + BEAM)


def chunk_amplitudes(bands: DataFrame, keys: Sequence[str], channels: int) -> DataFrame:
    """Amplitude of each antenna and chunk of ``channels`` channels (keys, ant, chunk, amp, weight): means over a chunk, polarisations by their weights.

    A mean's weight is one over its variance; gains that don't vary over the chunk (or are alone in it) count as known
    to a thousandth.  Channels without a gain don't count; a chunk without any gives no row.
    """
    amp = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    known = bands.select(*keys, "pol", "ant", funcs.blocks(F.col("chan"), channels).alias("chunk"), amp.alias("a")).where("a > 0 AND NOT isnan(a)")
    means = known.groupBy(*keys, "pol", "ant", "chunk").agg(F.avg("a").alias("a"), F.var_pop("a").alias("v"), F.count("*").alias("n"))
    means = means.withColumn("w", F.col("n") / F.greatest("v", F.pow(F.col("a") * 1e-3, 2)))
    return means.groupBy(*keys, "ant", "chunk").agg((F.sum(F.col("a") * F.col("w")) / F.sum("w")).alias("amp"), F.sum("w").alias("weight"))


def offsets(track: DataFrame) -> DataFrame:
    """Offsets (x, y, degrees) of pointings from their target; columns az, el, target_az, target_el in degrees.

    Distances from the target are kept (an arc projection), and x grows with azimuth.
    """
    az, el, az0, el0 = (F.radians(c) for c in ("az", "el", "target_az", "target_el"))
    l, m, _ = funcs.sin_projection(az, el, az0, el0)
    n = F.sin(el) * F.sin(el0) + F.cos(el) * F.cos(el0) * F.cos(az - az0)
    away = F.hypot(l, m)
    arc = F.when(away == 0, 1.0).otherwise(F.atan2(away, n) / away)
    return track.withColumn("x", F.degrees(l * arc)).withColumn("y", F.degrees(m * arc))


def directions(track: DataFrame) -> DataFrame:
    """Azimuth and elevation (az, el, degrees) of pointings at offsets x, y from target_az, target_el: the inverse of ``offsets``."""
    x, y, az0, el0 = (F.radians(c) for c in ("x", "y", "target_az", "target_el"))
    away = F.hypot(x, y)
    shrink = F.when(away == 0, 1.0).otherwise(F.sin(away) / away)
    l, m, n = x * shrink, y * shrink, F.cos(away)
    az = az0 + F.atan2(l, n * F.cos(el0) - m * F.sin(el0))
    return track.withColumn("az", F.pmod(F.degrees(az), F.lit(360.0))).withColumn("el", F.degrees(F.asin(m * F.cos(el0) + n * F.sin(el0))))

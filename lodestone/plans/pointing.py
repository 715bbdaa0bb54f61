"""Reference pointing: beams fitted to the bandpasses of a calibrator that was tracked at offsets.

Scans tagged ``pointingcal`` are solved for B with nothing applied; the solutions wait until a control row (``sync``,
see ``batcher``) of their capture block.  A sync takes the pointings of all batches up to its own that no earlier one
took, so none is fitted twice and what comes after the last sync waits.  Where the reference antenna pointed, and the air,
are the last readings of their logs at or before a pointing's middle, or the mean of the pointings' middles.

Pointings without a reading before them have no offset and don't count; a beam of fewer than five offsets, or without a
maximum inside, has null parameters and isn't valid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import keys
from lodestone.operators import astro, average, pointing, sensors, solve
from lodestone.sources.scratch import written

POINTING_TAG = "pointingcal"
PARTS = ("x0", "y0", "wx", "wy", "height")


@dataclass(frozen=True)
class Site:
    """Where the reference antenna stands and points, what it points at, and the air above it."""

    latitude: float
    longitude: float
    #: cb, ts, az, el (degrees).
    track: DataFrame
    #: target, ra, dec (degrees, J2000).
    places: DataFrame
    #: cb, ts, pressure_mb, celsius.
    air: DataFrame
    #: Channels of a chunk that has a beam of its own.
    chunk: int


def solve_pointings(rows: DataFrame, scans: DataFrame, n_ants: int, ref: int, block: int = 64) -> DataFrame:
    """B of each pointing scan (scan, time, chan, pol, ant, re, im), nothing applied before and not normalised; time is its middle."""
    wanted = scans.where(keys.any_tag_like(F.col("tags"), POINTING_TAG)).select("scan")
    own = rows.join(wanted, "scan", "left_semi")
    means = average.wavg(own, ["scan", "chan", "pol", "ant1", "ant2"]).withColumn("block", F.floor(F.col("chan") / block).cast("int"))
    times = own.groupBy("scan").agg(((F.min("ts") + F.max("ts")) / 2).alias("time"))
    return solve.solve_gains(means, ["scan", "block"], n_ants, ref).drop("block", "snr").join(times, "scan")


def taken_by(pointings: DataFrame, syncs: DataFrame) -> DataFrame:
    """Pointings (cb, batch, ...) with ``sync``, the batch of the first sync that comes at or after their own; those still waiting are left out."""
    marks = syncs.select("cb", "batch", F.col("batch").alias("_sync")).distinct().withColumn("_own", F.lit(0))
    both = pointings.withColumn("_own", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    # A sync comes after the rows of its batch.
    w = Window.partitionBy("cb").orderBy("batch", F.desc("_own")).rowsBetween(0, Window.unboundedFollowing)
    ahead = both.withColumn("sync", F.first("_sync", ignorenulls=True).over(w))
    return ahead.where("_own = 1 AND sync IS NOT NULL").select(*pointings.columns, "sync")


def pointing_offsets(pointings: DataFrame, site: Site) -> DataFrame:
    """Offsets of pointings (cb, sync, scan, time, target) with columns x and y, soltime (the mean of the middles) and the target of the first one."""
    over = Window.partitionBy("cb", "sync")
    first = F.min(F.struct("time", "scan", "target")).over(over)["target"]
    p = pointings.withColumn("soltime", F.avg("time").over(over)).withColumn("target", first)
    air = sensors.asof(p.withColumn("ts", F.col("soltime")), site.air, ["cb"], "ts", ["pressure_mb", "celsius"])
    at = sensors.asof(air.withColumn("ts", F.col("time")), site.track, ["cb"], "ts", ["az", "el"]).join(site.places, "target")
    az, el = astro.apparent_az_el(F.col("ts"), F.col("ra"), F.col("dec"), site.latitude, site.longitude)
    lifted = lambda e: e + astro.refraction_deg(e, F.col("pressure_mb"), F.col("celsius"))
    # A table: the places' long expressions would stand wherever the directions are used.
    seen = written(at.withColumns({"target_az": az, "target_el": el}), "directions")
    return pointing.offsets(seen.withColumns({c: lifted(F.col(c)) for c in ("target_el", "el")})).select("cb", "sync", "scan", "target", "soltime", "x", "y").where("x IS NOT NULL AND y IS NOT NULL")


def fit_pointings(bands: DataFrame, syncs: DataFrame, site: Site) -> DataFrame:
    """EPOINT of every sync: cb, sync, time, target, chunk, pol, ant, the beam and the ratio of each part to its error (that of the height is 0 if it isn't valid).

    ``bands``: cb, batch, target and the columns of ``solve_pointings``.  Polarisations are fitted as one and have the same beam.
    """
    scans = taken_by(bands.groupBy("cb", "batch", "scan").agg(F.first("target").alias("target"), F.first("time").alias("time")), syncs)
    at = pointing_offsets(scans, site)
    amps = pointing.chunk_amplitudes(bands, ["scan"], site.chunk)
    points = amps.join(at, "scan").withColumn("pol", F.lit("all"))
    beams = pointing.beam_fits(points, ["cb", "sync"]).drop("pol")
    pols = bands.join(scans.select("scan", "sync"), "scan").select("cb", "sync", "pol").distinct()
    told = at.groupBy("cb", "sync").agg(F.first("soltime").alias("time"), F.first("target").alias("target"))
    ratio = {f"{c}_snr": F.when(~F.isnan(f"{c}_err"), 1 / F.col(f"{c}_err")) for c in PARTS}
    ratio["height_snr"] = F.when(F.col("valid"), ratio["height_snr"]).otherwise(0.0)
    out = beams.withColumns(ratio).join(pols, ["cb", "sync"]).join(told, ["cb", "sync"])
    return out.select("cb", "sync", "time", "target", "chunk", "pol", "ant", *(F.nanvl(c, F.lit(None)).alias(c) for c in PARTS), "valid", *(f"{c}_snr" for c in PARTS))

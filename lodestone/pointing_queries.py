"""Queries of reference pointing over ``lineitem`` as an observation, with their SQL.

A scan is 150 orders.  In every ten scans nine are pointings on a grid of three by three offsets, and before the tenth the
pipeline is awaited; twenty scans are a capture block.  Gains are those of beams known for every antenna and channel, and
the log of the reference antenna tells where it stood, refraction taken off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.calibration_queries import ANTS, REF
from lodestone.operators import astro, pointing
from lodestone.plans import pointing as plan
from lodestone.queries import _r, query, vis
from lodestone.sources.scratch import written

LATITUDE, LONGITUDE, RA, DEC = 55.0, 12.0, 200.0, 75.0
PRESSURE, CELSIUS = 901.8, 15.9
WIDTHS = (0.8, 0.6)


def _offset(scan: Column) -> tuple[Column, Column]:
    k = scan % 10
    return (k % 3 - 1) * 0.5, (F.floor(k / 3) - 1) * 0.5


def _voltage(ant: Column) -> Column:
    x, y = _offset(F.col("scan"))
    away = F.pow((x - 0.1 * (ant % 3 - 1)) / WIDTHS[0], 2) + F.pow((y - 0.05 * (ant % 2)) / WIDTHS[1], 2)
    return (2 + 0.25 * F.col("chan") + 0.5 * (ant % 4)) * F.exp(-0.5 * away)


def observation(spark, sf: str) -> DataFrame:
    """cb, batch, scan, ts, dump, chan (0 or 1), pol, ant1, ant2, re, im, flags, weight; every 11th dump is flagged and wrong."""
    rows = vis(spark, sf).withColumns({"scan": F.floor(F.col("dump") / 150), "chan": (F.col("chan") % 2).cast("int"), "bad": F.col("dump") % 11 == 3})
    size = _voltage(F.col("ant1")) * _voltage(F.col("ant2")) * F.when(F.col("bad"), 1000.0).otherwise(1.0)
    block = F.concat(F.lit("cb"), F.floor(F.col("scan") / 20).cast("string"))
    return rows.select(block.alias("cb"), F.col("scan").alias("batch"), "scan", (1.7e9 + 4.0 * F.col("dump")).alias("ts"), "dump", "chan", "pol", "ant1", "ant2", size.alias("re"), F.lit(0.0).alias("im"), F.col("bad").cast("int").alias("flags"), "weight")


def site(observed: DataFrame) -> plan.Site:
    """The logs: a reading at the start of each scan, of the direction at its middle (of the rows given); the air's at the start of each capture block."""
    spark = observed.sparkSession
    scans = observed.groupBy("cb", "scan").agg(F.min("ts").alias("ts"), ((F.min("ts") + F.max("ts")) / 2).alias("middle"))
    az, el = astro.apparent_az_el(F.col("middle"), F.lit(RA), F.lit(DEC), LATITUDE, LONGITUDE)
    x, y = _offset(F.col("scan"))
    lift = lambda e: astro.refraction_deg(e, F.lit(PRESSURE), F.lit(CELSIUS))
    placed = written(scans.withColumns({"target_az": az, "target_el": el, "x": x, "y": y}), "placed")
    seen = written(pointing.directions(placed.withColumn("target_el", F.col("target_el") + lift(F.col("target_el")))), "seen")
    below = F.col("el") - lift(F.col("el"))
    for _ in range(2):
        below = F.col("el") - lift(below)
    air = observed.groupBy("cb").agg(F.min("ts").alias("ts")).withColumns({"pressure_mb": F.lit(PRESSURE), "celsius": F.lit(CELSIUS)})
    places = spark.range(1).select(F.lit("beacon").alias("target"), F.lit(RA).alias("ra"), F.lit(DEC).alias("dec"))
    return plan.Site(LATITUDE, LONGITUDE, seen.select("cb", "ts", "az", below.alias("el")), places, air, 1)


def scans(observed: DataFrame) -> DataFrame:
    """A row per scan; the one before which the pipeline is awaited is a target."""
    tags = F.array(F.when(F.col("scan") % 10 < 9, "pointingcal").otherwise("target"))
    return observed.groupBy("cb", "batch", "scan").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1")).withColumns({"target": F.lit("beacon"), "tags": tags})


@query("""WITH s AS (SELECT DISTINCT l_orderkey // 150 AS scan FROM lineitem WHERE (l_orderkey // 150) % 10 = 9), a AS (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS ant), c AS (SELECT CAST(unnest([0, 1]) AS INTEGER) AS chunk), p(pol) AS (VALUES ('h'), ('v'))
SELECT 'cb' || CAST(scan // 20 AS VARCHAR) AS cb, scan - 1 AS sync, 'beacon' AS target, chunk, pol, ant, round(0.1 * (ant % 3 - 1), 3) + 0.0 AS x0, round(0.05 * (ant % 2), 3) AS y0, 0.8 AS wx, 0.6 AS wy, round(2 + 0.25 * chunk + 0.5 * (ant % 4), 3) AS height, true AS valid FROM s, a, c, p""")
def reference_pointing(spark, sf):
    """EPOINT of every sync: the beams of all antennas and channels from the bandpasses at nine offsets before it."""
    observed = written(observation(spark, sf), "observation")
    told = scans(observed)
    cross = observed.where("ant1 <> ant2")
    bands = plan.solve_pointings(cross, told, ANTS, REF)
    syncs = told.where("scan % 10 = 9").select("cb", (F.col("batch") - 1).alias("batch"))
    stored = written(bands.join(told.select("scan", "cb", "batch", "target"), "scan"), "bands")
    beams = plan.fit_pointings(stored, syncs, site(cross))
    return beams.select("cb", "sync", "target", "chunk", "pol", "ant", *((_r(c, 3) + 0.0).alias(c) for c in plan.PARTS), "valid")

"""Queries of the cross-hand chain over ``lineitem`` as an observation of four hands, with their SQL.

Gains, delays and bandpasses are those of ``calibration_queries``; the cross hands lag by a delay of the scan, and on
autocorrelations the diode's phase of the antenna comes on top.  A third of the baselines' rows, and all of the autocorrelations,
are taken as both cross hands.  Every scan is a polarisation and a beamformer calibrator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.calibration_queries import ANTS, REF, TURNS, _gain, channels
from lodestone.functions import cplx
from lodestone.plans import crosshands, reduction
from lodestone.queries import _r, query, vis
from lodestone.sources.scratch import written

#: A spline of the second degree (knots in MHz, degrees): 40 t (1 - t) + 90 t^2 with t from 800 to 1800 MHz.
SKY = ([800.0] * 3 + [1800.0] * 3, [0.0, 20.0, 90.0, 0.0, 0.0, 0.0], 2)
SETTINGS = reduction.Settings(sky_spline=SKY)


def _turn(ant: Column) -> cplx.Complex:
    return tuple(F.element_at(F.array(*(F.lit(t[k]) for t in TURNS)), (ant % 4 + 1).cast("int")) for k in (0, 1))


def _lag(scan: Column) -> Column:
    return (scan % 5 - 2) * 1e-9


def _slope(ant: Column) -> Column:
    return 1 + (F.col("chan") - 4) * 0.05 * (1 - 2 * (ant % 2))


def _level(scan: Column) -> Column:
    return 1 + 0.5 * (scan % 3)


def four_hands(spark, sf: str) -> DataFrame:
    """scan, ts, dump, chan, pol (two letters), ant1, ant2, re, im, flags, weight; every 11th dump is flagged and wrong."""
    rows = vis(spark, sf).join(channels(spark), "chan").withColumn("scan", F.floor(F.col("dump") / 500).cast("int"))
    auto = F.col("ant1") == F.col("ant2")
    hands = F.when(auto | ((F.col("dump") + F.col("chan")) % 3 == 0), F.array(F.lit("hv"), F.lit("vh"))).otherwise(F.array(F.concat("pol", "pol")))
    rows = rows.withColumn("pol", F.explode(hands)).withColumn("bad", F.col("dump") % 11 == 3)
    (r1, i1, k1), (r2, i2, k2) = (_gain(F.col(a), F.substring("pol", n, 1)) for a, n in (("ant1", 1), ("ant2", 2)))
    seen = cplx.mul(cplx.mul((r1, i1), cplx.conj((r2, i2))), cplx.delay_phasor(k1 - k2, F.col("freq_hz")))
    sign = F.when(F.col("pol") == "hv", 1.0).when(F.col("pol") == "vh", -1.0).otherwise(0.0)
    c, s = _turn(F.col("ant1"))
    seen = cplx.mul(seen, cplx.delay_phasor(_lag(F.col("scan")) * sign, F.col("freq_hz")))
    seen = cplx.mul(seen, (F.when(auto, c).otherwise(1.0), F.when(auto, s * sign).otherwise(0.0)))
    size = F.pow(_level(F.col("scan")), 2) * _slope(F.col("ant1")) * _slope(F.col("ant2")) * F.when(F.col("bad"), 1000.0).otherwise(1.0)
    return rows.select("scan", (100 + 4.0 * F.col("dump")).alias("ts"), "dump", "chan", "pol", "ant1", "ant2", (seen[0] * size).alias("re"), (seen[1] * size).alias("im"), F.col("bad").cast("int").alias("flags"), "weight")


def _solved(scans: DataFrame, spark) -> tuple[DataFrame, DataFrame]:
    """K times B, and G, of every scan: what the solvers of the parallel hands give."""
    ends = scans.select("scan", F.explode(F.sequence(F.lit(0), F.lit(ANTS - 1))).alias("ant")).withColumn("pol", F.explode(F.array(F.lit("h"), F.lit("v"))))
    re, im, k = _gain(F.col("ant"), F.col("pol"))
    g = ends.select("scan", "pol", "ant", (re * _level(F.col("scan"))).alias("re"), (im * _level(F.col("scan"))).alias("im"))
    z = cplx.scale(cplx.delay_phasor(k, F.col("freq_hz")), _slope(F.col("ant")))
    return ends.crossJoin(channels(spark)).select("scan", "chan", "pol", "ant", z[0].alias("re"), z[1].alias("im")), g


def _scans(observed: DataFrame) -> DataFrame:
    times = observed.groupBy("scan").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return times.withColumn("tags", F.array(F.lit("polcal"), F.lit("bfcal")))


@query("SELECT scan, pol, CASE WHEN pol = 'h' THEN CAST(scan % 5 - 2 AS DOUBLE) ELSE 0.0 END + 0.0 AS delay_ns FROM (SELECT DISTINCT CAST(l_orderkey // 500 AS INTEGER) AS scan FROM lineitem), (VALUES ('h'), ('v')) p(pol)")
def cross_hand_delay(spark, sf):
    """KCROSS per scan from cross-correlations of four hands, K, B and preliminary gains applied."""
    observed = written(four_hands(spark, sf), "observation")
    scans = written(_scans(observed), "scans")
    band, g = _solved(scans, spark)
    # The scans' gains are left to the preliminary solution.
    k = crosshands.solve_polcal(observed, scans, channels(spark), band, ANTS, REF, SETTINGS)["KCROSS"]
    return k.select("scan", "pol", (_r(F.col("delay") * 1e9, 3) + 0.0).alias("delay_ns"))


def diode_log(observed: DataFrame) -> DataFrame:
    """A reading per antenna and scan: on in every fourth scan of an antenna."""
    first = observed.where("ant1 = ant2").groupBy("scan", F.col("ant1").alias("ant")).agg(F.min("ts").alias("ts"))
    return first.select("ant", "ts", ((F.col("scan") + F.col("ant")) % 4 == 0).cast("double").alias("value"))


def _diode(spark, sf: str) -> dict[str, DataFrame]:
    observed = written(four_hands(spark, sf), "observation")
    scans = written(_scans(observed), "scans")
    return crosshands.solve_diode(observed, scans, channels(spark), *_solved(scans, spark), diode_log(observed), SETTINGS)


# What was on: a reading within the scan, or the last one before its start.
_ON = """WITH o AS (SELECT CAST(l_orderkey // 500 AS INTEGER) AS scan, l_linenumber AS chan, CAST(l_suppkey % 8 AS INTEGER) AS ant, l_orderkey AS dump, CAST(l_partkey % 8 AS INTEGER) AS ant2 FROM lineitem),
t AS (SELECT scan, min(dump) AS d0, max(dump) AS d1 FROM o GROUP BY scan), r AS (SELECT scan, ant, min(dump) AS dump, (scan + ant) % 4 = 0 AS lit FROM o WHERE ant = ant2 GROUP BY scan, ant),
b AS (SELECT t.scan, r.ant, arg_max(r.lit, r.dump) AS lit FROM t JOIN r ON r.dump < t.d0 GROUP BY ALL),
lit AS (SELECT scan, ant FROM r WHERE lit UNION SELECT scan, ant FROM b WHERE lit),
c AS (SELECT scan, chan, ant, bool_or(dump % 11 <> 3) AS good FROM o WHERE ant = ant2 AND scan IN (SELECT scan FROM lit) GROUP BY ALL),
z AS (SELECT c.*, lit.ant IS NOT NULL AS lit, [1.0, 0.6, 0.8, 0.28][CAST(c.ant % 4 AS INTEGER) + 1]::DOUBLE AS re, [0.0, 0.8, -0.6, 0.96][CAST(c.ant % 4 AS INTEGER) + 1]::DOUBLE AS im FROM c LEFT JOIN lit ON c.scan = lit.scan AND c.ant = lit.ant)"""


@query(f"{_ON} SELECT scan, chan, ant, CASE WHEN lit AND good THEN round(re, 3) END AS re, CASE WHEN lit AND good THEN round(im, 3) + 0.0 END AS im FROM z")
def cross_hand_phase(spark, sf):
    """BCROSS_DIODE: the diode's phase of each antenna and channel, null where it wasn't on."""
    b = _diode(spark, sf)["BCROSS_DIODE"].where("pol = 'h'")
    return b.select("scan", "chan", "ant", _r("re", 3).alias("re"), (_r("im", 3) + 0.0).alias("im"))


@query(f"""{_ON}, s AS (SELECT scan, chan, list_sort(list({{'re': re, 'im': im}})) AS z FROM z WHERE lit AND good GROUP BY ALL),
m AS (SELECT scan, chan, (z[(len(z) + 1) // 2].re + z[len(z) // 2 + 1].re) / 2 AS re, (z[(len(z) + 1) // 2].im + z[len(z) // 2 + 1].im) / 2 AS im, ((1284 + chan - 4) - 800) / 1000.0 AS t FROM s),
a AS (SELECT *, radians(40 * t * (1 - t) + 90 * t * t) AS a FROM m)
SELECT z.scan, z.chan, z.ant, round(a.re * cos(a) - a.im * sin(a), 3) + 0.0 AS re, round(a.re * sin(a) + a.im * cos(a), 3) + 0.0 AS im FROM z LEFT JOIN a ON z.scan = a.scan AND z.chan = a.chan""")
def cross_hand_sky(spark, sf):
    """BCROSS_DIODE_SKY: the antennas' median phase, turned by a spline of the second degree."""
    b = _diode(spark, sf)["BCROSS_DIODE_SKY"].where("pol = 'h'")
    return b.select("scan", "chan", "ant", (_r("re", 3) + 0.0).alias("re"), (_r("im", 3) + 0.0).alias("im"))

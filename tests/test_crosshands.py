"""The cross-hand chain in the plan: delays, diodes, phases per channel, and the turn to the sky."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import solve
from lodestone.plans import crosshands, reduction
from lodestone.sources import synthetic

CHANS, DUMPS, ANTS = 32, 4, 5
#: Delay (s) and phase that each antenna's diode adds, and a spline of 0 to 90 degrees over the band.
EXTRA, PHASE = np.array([0.0, 4e-11, -3e-11, 1e-11, 9e-11]), np.array([0.1, 0.4, -0.2, 0.3, 0.0])
SPLINE = ([800.0, 800.0, 1800.0, 1800.0], [0.0, 90.0, 0.0, 0.0], 1)
COLUMNS = ("ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight")


@pytest.fixture(scope="module")
def truth():
    return synthetic.Truth(n_ants=ANTS, seed=2)


def _scans(spark, tags):
    rows = [(k, k, f"t{k}", t.split(), 100.0 + 4 * DUMPS * k, 100.0 + 4 * (DUMPS * (k + 1) - 1)) for k, t in enumerate(tags)]
    return spark.createDataFrame(rows, "scan int, batch int, target string, tags array<string>, t0 double, t1 double")


def _observed(spark, truth, n):
    return synthetic.visibilities(spark, truth, CHANS, DUMPS * n).select(*COLUMNS), synthetic.channel_table(spark, CHANS, 856e6, 1284e6)


def test_cross_delay_of_a_polarisation_calibrator(spark, truth):
    v, channels = _observed(spark, truth, 2)
    # A baseline without a VH hand has strange HV values, which must not count; neither must flagged cells.
    v = v.where("NOT (ant1 = 0 AND ant2 = 3 AND pol = 'vh')").withColumn("re", F.when(F.expr("ant1 = 0 AND ant2 = 3 AND pol = 'hv'"), 500.0).otherwise(F.col("re")))
    bad = (F.col("chan") == 7) & (F.col("dump") >= DUMPS)
    v = v.withColumn("re", F.when(bad, 900.0).otherwise(F.col("re"))).withColumn("flags", F.when(bad, 1).otherwise(0))
    got = reduction.reduce_scans(v, _scans(spark, ["delaycal bpcal gaincal", "polcal"]), channels, ANTS, 1, reduction.Settings(k_window=(2, 30), kcross_average=2))
    k = {r.pol: r.delay for r in got["KCROSS"].collect()}
    assert k.keys() == {"h", "v"} and k["v"] == 0 and np.isclose(k["h"], truth.delay[1, 1] - truth.delay[0, 1], rtol=1e-2)
    flat = got["cross"].where("flags = 0 AND ant1 + ant2 <> 3").select("chan", "pol", "re", "im", "ant1", "ant2").toPandas()
    assert len(flat) and ((flat.ant1 == 1) | (flat.ant2 == 1)).all() and set(flat.pol) == {"hv", "vh"}
    z = (flat.re + 1j * flat.im).to_numpy()
    assert np.abs(np.abs(z) - 1).max() < 2e-2 and np.ptp(np.angle(z)[flat.pol == "hv"]) < 2e-2
    assert "KCROSS_DIODE" not in got


def test_two_hands_have_no_cross_products(spark, truth):
    v, channels = _observed(spark, truth, 2)
    got = reduction.reduce_scans(v.where("pol IN ('hh', 'vv')"), _scans(spark, ["delaycal bpcal gaincal", "polcal"]), channels, ANTS, 1)
    assert got["KCROSS"].count() == 0 and got["cross"].count() == 0


def test_diode_chain_of_a_beamformer_calibrator(spark, truth):
    v, channels = _observed(spark, truth, 2)
    a, f = F.col("ant1") + 1, 856e6 / CHANS * (F.col("chan") - CHANS // 2) + 1284e6
    item = lambda x: F.element_at(F.array(*(F.lit(float(y)) for y in x)), a)
    angle = F.when(F.col("ant1") == F.col("ant2"), 2 * np.pi * item(EXTRA) * f + item(PHASE)).otherwise(0.0) * F.when(F.col("pol") == "hv", 1).when(F.col("pol") == "vh", -1).otherwise(0)
    v = v.withColumn("_re", F.col("re") * F.cos(angle) - F.col("im") * F.sin(angle)).withColumn("im", F.col("re") * F.sin(angle) + F.col("im") * F.cos(angle)).withColumn("re", F.col("_re")).drop("_re")
    # Antenna 4 never fires; 3 was on before the scan and is switched off in it; 2 fires within it. In the second scan none is on.
    log = [(0, 0.0, 1.0), (0, 115.5, 0.0), (1, 101.0, 0.3), (1, 113.0, 0.0), (2, 104.0, 1.0), (2, 108.0, 0.0), (3, 99.0, 1.0), (3, 101.0, 0.0), (4, 0.0, 0.0)]
    diode = spark.createDataFrame(log, "ant int, ts double, value double")
    got = reduction.reduce_scans(v, _scans(spark, ["bfcal", "bfcal"]), channels, ANTS, 0, reduction.Settings(sky_spline=SPLINE), diode=diode)
    dk = truth.delay[1, 0] - truth.delay[0, 0]
    k = got["KCROSS_DIODE"].orderBy("pol", "ant").toPandas()
    assert set(k.scan) == {0}
    assert np.allclose(k.delay[:4], dk + EXTRA[:4], rtol=1e-2, atol=2e-13) and np.isnan(k.delay[4]) and (k.delay[5:9] == 0).all() and np.isnan(k.delay[9])
    freq = (np.arange(CHANS) - CHANS // 2) * 856e6 / CHANS + 1284e6
    middle = np.median(EXTRA[:4])
    ref = np.angle(truth.gain[1, 0]) - np.angle(truth.gain[0, 0])
    b = got["BCROSS_DIODE"].where("pol = 'h'").orderBy("ant", "chan").toPandas()
    z = (b.re + 1j * b.im).to_numpy().reshape(ANTS, CHANS)
    want = np.exp(1j * (ref + PHASE[:4, None] + 2 * np.pi * (EXTRA[:4, None] - middle) * freq))
    assert np.allclose(np.abs(z[:4]), 1) and np.abs(z[:4] - want).max() < 3e-2 and np.isnan(z[4]).all()
    flat = got["auto_cross"].where("ant1 < 4 AND pol = 'hv'").toPandas()
    assert len(flat) == 4 * CHANS and np.allclose(flat.re, 1, atol=2e-2) and np.allclose(flat.im, 0, atol=2e-2)
    sky = got["BCROSS_DIODE_SKY"].where("pol = 'h'").orderBy("ant", "chan").toPandas()
    s = (sky.re + 1j * sky.im).to_numpy().reshape(ANTS, CHANS)
    turn = np.exp(1j * np.radians(0.09 * (freq / 1e6 - 800)))
    sets = np.sort(z[:4], axis=0)  # by real, then imaginary part
    assert np.allclose(s, (sets[1] + sets[2]) / 2 * turn, atol=1e-9)
    other = got["BCROSS_DIODE_SKY"].where("pol = 'v'").select("re", "im").distinct().collect()
    assert [(r.re, r.im) for r in other] == [(1.0, 0.0)]


def test_median_of_complex_values(spark):
    rows = [("a", 1.0, 0.0), ("a", 1.0, -2.0), ("a", 3.0, 1.0), ("b", 1.0, 1.0), ("b", 2.0, 4.0), ("b", None, None), ("c", None, None)]
    got = {r.k: (r.re, r.im) for r in crosshands.complex_median(spark.createDataFrame(rows, "k string, re double, im double"), ["k"]).collect()}
    assert got == {"a": (1.0, 0.0), "b": (1.5, 2.5), "c": (None, None)}


def test_first_hand_v_turns_the_other_way(spark):
    channels = synthetic.channel_table(spark, 8, 856e6, 1284e6)
    b = channels.select(F.lit(0).alias("scan"), "chan", F.explode(F.array(F.lit("v"), F.lit("h"))).alias("pol"), F.lit(3).alias("ant"), F.lit(1.0).alias("re"), F.lit(0.0).alias("im"))
    both = [crosshands.to_sky(b.withColumn("pol", F.translate("pol", "vh", p)), channels, SPLINE, p[0]).where(f"pol = '{p[0]}'").orderBy("chan").toPandas() for p in ("vh", "hv")]
    assert np.allclose(both[0].re, both[1].re) and np.allclose(both[0].im, -both[1].im) and (both[1].im > 0).all()


def test_spline_equals_its_recursion_one_by_one():
    rng = np.random.default_rng(5)
    knots, coefs = np.sort(np.r_[[0.0] * 4, rng.uniform(0, 1, 3), [1.0] * 4]), rng.normal(size=7)

    def base(i, k, x):
        if k == 0:
            return float(knots[i] <= x < knots[i + 1])
        a, b = knots[i + k] - knots[i], knots[i + k + 1] - knots[i + 1]
        return ((x - knots[i]) / a * base(i, k - 1, x) if a else 0) + ((knots[i + k + 1] - x) / b * base(i + 1, k - 1, x) if b else 0)

    at = rng.uniform(0, 0.999, 40)
    assert np.allclose(solve.spline(at, knots, coefs, 3), [sum(coefs[i] * base(i, 3, x) for i in range(7)) for x in at])

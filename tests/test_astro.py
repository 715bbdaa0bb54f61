"""Apparent places against worked examples of Meeus, Astronomical Algorithms (1998)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestone.operators import astro

ARCSEC = 1 / 3600


def _unix(*day, hours=0.0):
    return F.lit(dt.datetime(*day, tzinfo=dt.timezone.utc).timestamp() + 3600 * hours)


def _values(spark, *columns):
    return list(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_theta_persei(spark):
    """Example 21.b and 23.a: 2028 November 13.19, proper motion applied."""
    now, ra, dec = _unix(2028, 11, 13, hours=24 * 0.19), F.lit(41.054063), F.lit(49.227750)
    a, d, da, dd, x, y = _values(spark, *astro.precession(now, ra, dec), *astro.aberration(now, F.lit(41.547214), F.lit(49.348483)), *astro.apparent(now, ra, dec))
    assert a == pytest.approx(41.547214, abs=2e-6) and d == pytest.approx(49.348483, abs=2e-6)
    assert da == pytest.approx(30.045 * ARCSEC, abs=0.05 * ARCSEC) and dd == pytest.approx(6.697 * ARCSEC, abs=0.05 * ARCSEC)
    assert x == pytest.approx(15 * (2 + 46 / 60 + 14.390 / 3600), abs=ARCSEC) and y == pytest.approx(49 + 21 / 60 + 7.45 / 3600, abs=ARCSEC)


def test_nutation_and_sidereal_time(spark):
    """Examples 22.a and 12.a: 1987 April 10."""
    now = _unix(1987, 4, 10)
    psi, eps, tilt, mean, true = _values(spark, *astro.nutation(now), astro.sidereal_deg(now, 0.0), astro.apparent_sidereal_deg(now, 0.0))
    assert psi == pytest.approx(-3.788 * ARCSEC, abs=0.5 * ARCSEC) and eps == pytest.approx(9.443 * ARCSEC, abs=0.1 * ARCSEC)
    assert tilt == pytest.approx(23 + 26 / 60 + 36.850 / 3600, abs=0.1 * ARCSEC)
    assert mean == pytest.approx(15 * (13 + 10 / 60 + 46.3668 / 3600), abs=0.05 * ARCSEC)
    assert true == pytest.approx(15 * (13 + 10 / 60 + 46.1351 / 3600), abs=0.5 * ARCSEC)


def test_the_sun(spark):
    """Example 25.a: 1992 October 13."""
    assert _values(spark, astro.sun_longitude(_unix(1992, 10, 13)))[0] == pytest.approx(199.90988, abs=1e-5)


def test_null_and_no_time_since_the_epoch(spark):
    ra, dec, none = _values(spark, *astro.precession(_unix(2000, 1, 1, hours=12), F.lit(350.0), F.lit(-30.0)), astro.apparent(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0))[0])
    assert ra == pytest.approx(350.0) and dec == pytest.approx(-30.0) and none is None

"""Directions on the sky as columns: sidereal time, apparent places, azimuth and elevation, baselines as u, v, w, refraction.

Angles in degrees unless said otherwise.  Places are taken as they are given: ``apparent`` turns mean ones of J2000 into
those of date (precession, nutation and annual aberration, within an arcsecond; within a degree of the poles the latter
two, which are first-order terms in right ascension and declination, lose that).  Null in any argument gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIGHT = 299792458.0


def sidereal_deg(unix: Column, longitude: float) -> Column:
    """Local mean sidereal time (Meeus 1998, chapter 12, linear terms)."""
    days = unix / 86400.0 - 10957.5  # since 2000-01-01 12:00
    return F.pmod(F.lit(280.46061837 + longitude) + days * 360.98564736629, F.lit(360.0))


def centuries(unix: Column) -> Column:
    """Julian centuries from J2000."""
    return (unix / 86400.0 - 10957.5) / 36525.0


def _polynomial(t: Column, *terms: float) -> Column:
    total = F.lit(terms[-1])
    for c in reversed(terms[:-1]):
        total = total * t + F.lit(c)
    return total


def _sin(x: Column) -> Column:
    return F.sin(F.radians(x))


def _cos(x: Column) -> Column:
    return F.cos(F.radians(x))


def precession(unix: Column, ra: Column, dec: Column) -> tuple[Column, Column]:
    """Mean place of date of a mean place of J2000 (Meeus 1998, chapter 21)."""
    t = centuries(unix)
    # Fixed values, arcseconds.
    zeta, z, theta = (_polynomial(t, 0.0, *c) / 3600.0 for c in ((2306.2181, 0.30188, 0.017998), (2306.2181, 1.09468, 0.018203), (2004.3109, -0.42665, -0.041833)))
    east, toward = _cos(dec) * _sin(ra + zeta), _cos(dec) * _cos(ra + zeta)
    new = F.degrees(F.atan2(east, _cos(theta) * toward - _sin(theta) * _sin(dec))) + z
    return F.pmod(new, F.lit(360.0)), F.degrees(F.asin(_sin(theta) * toward + _cos(theta) * _sin(dec)))


def nutation(unix: Column) -> tuple[Column, Column, Column]:
    """Nutation in longitude and obliquity, and the true obliquity (largest terms, Meeus 1998, chapter 22)."""
    t = centuries(unix)
    node, sun, moon = _polynomial(t, 125.04452, -1934.136261), _polynomial(t, 280.4665, 36000.7698), _polynomial(t, 218.3165, 481267.8813)
    psi = (-17.20 * _sin(node) - 1.32 * _sin(2 * sun) - 0.23 * _sin(2 * moon) + 0.21 * _sin(2 * node)) / 3600.0
    eps = (9.20 * _cos(node) + 0.57 * _cos(2 * sun) + 0.10 * _cos(2 * moon) - 0.09 * _cos(2 * node)) / 3600.0
    return psi, eps, _polynomial(t, 23.0 + 26.0 / 60 + 21.448 / 3600, -46.8150 / 3600) + eps


def sun_longitude(unix: Column) -> Column:
    """The Sun's true longitude (Meeus 1998, chapter 25)."""
    t = centuries(unix)
    m = _polynomial(t, 357.52911, 35999.05029, -0.0001537)
    centre = _polynomial(t, 1.914602, -0.004817) * _sin(m) + _polynomial(t, 0.019993, -0.000101) * _sin(2 * m) + 0.000289 * _sin(3 * m)
    return F.pmod(_polynomial(t, 280.46646, 36000.76983, 0.0003032) + centre, F.lit(360.0))


def aberration(unix: Column, ra: Column, dec: Column) -> tuple[Column, Column]:
    """What the Earth's motion adds to right ascension and declination (Meeus 1998, chapter 23)."""
    t, sun = centuries(unix), sun_longitude(unix)
    tilt = nutation(unix)[2]
    # The circular part, and that of the orbit's shape (eccentricity, perihelion).
    parts = ((F.lit(-1.0), sun), (_polynomial(t, 0.016708634, -0.000042037), _polynomial(t, 102.93735, 1.71946, 0.00046)))
    along = sum((size * (_cos(ra) * _cos(x) * _cos(tilt) + _sin(ra) * _sin(x)) for size, x in parts), F.lit(0.0)) / _cos(dec)
    up = sum((size * (_cos(x) * (_sin(tilt) * _cos(dec) - _cos(tilt) * _sin(ra) * _sin(dec)) + _cos(ra) * _sin(dec) * _sin(x)) for size, x in parts), F.lit(0.0))
    return along * (20.49552 / 3600), up * (20.49552 / 3600)


def apparent(unix: Column, ra: Column, dec: Column) -> tuple[Column, Column]:
    """Apparent place of date of a mean place of J2000."""
    a, d = precession(unix, ra, dec)
    psi, eps, tilt = nutation(unix)
    along, up = aberration(unix, a, d)
    slope = F.tan(F.radians(d))
    turned = a + (_cos(tilt) + _sin(tilt) * _sin(a) * slope) * psi - _cos(a) * slope * eps + along
    return F.pmod(turned, F.lit(360.0)), d + _sin(tilt) * _cos(a) * psi + _sin(a) * eps + up


def apparent_sidereal_deg(unix: Column, longitude: float) -> Column:
    """Local apparent sidereal time: the mean one and the nutation along the equator."""
    psi, _, tilt = nutation(unix)
    return F.pmod(sidereal_deg(unix, longitude) + psi * _cos(tilt), F.lit(360.0))


def apparent_az_el(unix: Column, ra: Column, dec: Column, latitude: float, longitude: float) -> tuple[Column, Column]:
    """Azimuth and elevation of a mean place of J2000, by its apparent place and time."""
    return az_el(unix, *apparent(unix, ra, dec), latitude, longitude, apparent_sidereal_deg(unix, longitude))


def az_el(unix: Column, ra: Column, dec: Column, latitude: float, longitude: float, sidereal: Column | None = None) -> tuple[Column, Column]:
    """Azimuth (from north through east) and elevation; by the mean sidereal time unless another is given."""
    now = sidereal_deg(unix, longitude) if sidereal is None else sidereal
    h, d, p = F.radians(now - ra), F.radians(dec), F.radians(F.lit(latitude))
    north = F.sin(d) * F.cos(p) - F.cos(d) * F.cos(h) * F.sin(p)
    el = F.asin(F.sin(d) * F.sin(p) + F.cos(d) * F.cos(h) * F.cos(p))
    return F.pmod(F.degrees(F.atan2(-F.cos(d) * F.sin(h), north)), F.lit(360.0)), F.degrees(el)


def refraction_deg(el: Column, pressure_mb: Column, celsius: Column) -> Column:
    """What the air adds to an elevation (Saemundsson 1986)."""
    return 1.02 / F.tan(F.radians(el + 10.3 / (el + 5.11))) / 60 * (pressure_mb / 1010.0) * (283.0 / (273.0 + celsius))


def uvw(unix: Column, ra: Column, dec: Column, east: Column, north: Column, up: Column, latitude: float, longitude: float) -> tuple[Column, Column, Column]:
    """u, v, w (metres) of a baseline given by its east, north and up parts."""
    h, d, p = F.radians(sidereal_deg(unix, longitude) - ra), F.radians(dec), F.radians(F.lit(latitude))
    x, y, z = -F.sin(p) * north + F.cos(p) * up, east, F.cos(p) * north + F.sin(p) * up
    u = F.sin(h) * x + F.cos(h) * y
    v = -F.sin(d) * F.cos(h) * x + F.sin(d) * F.sin(h) * y + F.cos(d) * z
    w = F.cos(d) * F.cos(h) * x - F.cos(d) * F.sin(h) * y + F.sin(d) * z
    return u, v, w


def wavelengths(metres: Column, freq_hz: Column) -> Column:
    return metres * freq_hz / LIGHT

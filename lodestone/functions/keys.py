"""Times, names and tags as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Modified Julian Date of the Unix epoch.
MJD_UNIX = 40587.0


def mjd_seconds_to_unix(mjd_s: Column) -> Column:
    return (mjd_s / 86400.0 - MJD_UNIX) * 86400.0


def unix_to_mjd_seconds(unix_s: Column) -> Column:
    return (unix_s / 86400.0 + MJD_UNIX) * 86400.0


def dump_time(index: Column, first: float, int_time: float, sync: float = 0.0) -> Column:
    """Unix time of a dump."""
    return F.lit(first) + index * F.lit(int_time) + F.lit(sync)


def snr_key(key: Column) -> Column:
    """Product key with the SNR token behind the first one."""
    return F.regexp_replace(key, "^([^_]+)_", "$1_SNR_")


def target_name(description: Column) -> Column:
    """First name of a target description, 'unknown' if there is none."""
    name = F.trim(F.split(F.element_at(F.split(description, ","), 1), r"\|")[0])
    return F.coalesce(F.when(name != "", name), F.lit("unknown"))


def target_tags(description: Column) -> Column:
    """Tags of a target description as an array; ['unknown'] if there are none."""
    second = F.trim(F.try_element_at(F.split(description, ","), F.lit(2)))
    return F.when(F.coalesce(second, F.lit("")) == "", F.array(F.lit("unknown"))).otherwise(F.split(second, r"\s+"))


def any_tag_like(tags: Column, part: str) -> Column:
    return F.exists(tags, lambda t: F.contains(t, F.lit(part)))


def has_tag(tags: Column, tag: str) -> Column:
    return F.array_contains(tags, tag)


def utc(ts: Column, day_only: bool = False) -> Column:
    return F.date_format(ts, "dd HH:mm:ss" if day_only else "yyyy-MM-dd HH:mm:ss")


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def comma_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: F.trim(x))


def blocks(channel: Column, size: int) -> Column:
    return F.floor(channel / F.lit(size)).cast("int")


def server_of(channel: Column, n_chans: int, servers: int) -> Column:
    return F.floor(channel / F.lit(n_chans // servers)).cast("int")


def haversine_deg(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Angular separation of positions in radians, in degrees."""
    h = F.pow(F.sin((dec2 - dec1) / 2), 2) + F.cos(dec1) * F.cos(dec2) * F.pow(F.sin((ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(h)))


def sin_projection(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column, Column]:
    """Direction cosines (l, m, n) about a phase centre."""
    d = ra - ra0
    l = F.cos(dec) * F.sin(d)
    m = F.sin(dec) * F.cos(dec0) - F.cos(dec) * F.sin(dec0) * F.cos(d)
    return l, m, F.sqrt(F.greatest(F.lit(0.0), 1 - l * l - m * m))

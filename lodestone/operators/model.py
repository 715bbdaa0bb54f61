"""Sky models: component tables, fluxes, and model visibilities."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import keys

LIGHT = 299792458.0
COMPONENT = "model string, comp int, name string, ra double, dec double, kind string, fmin_mhz double, fmax_mhz double, s0 double, coeffs array<double>, is_log boolean, ref_hz double"


def angle(text: str, hours: bool) -> float:
    """Radians of 'dd:mm:ss' (or hh:mm:ss) or decimal degrees."""
    parts = text.strip().split(":")
    if len(parts) == 1:
        return math.radians(float(parts[0]))
    sign = -1 if parts[0].strip().startswith("-") else 1
    value = sum(abs(float(p)) / 60**k for k, p in enumerate(parts))
    return sign * math.radians(value * (15 if hours else 1))


def parse_component(line: str) -> tuple | None:
    """(name, ra, dec, kind, fmin, fmax, s0, coefficients, is_log, ref_hz) of a component line.

    ``name list, tags, ra, dec, flux``; the flux is ``(fmin fmax a0 a1 ...)``, a polynomial of
    log10 flux in log10 MHz, or ``fmin fmax wsclean S [c1 ...] true|false ref_hz``.  Blank
    lines and comments give None.
    """
    line = line.split("#")[0].strip()
    if not line:
        return None
    name, _, ra, dec, *flux = (x.strip() for x in line.split(",", 4))
    body = flux[0].strip("() ") if flux else ""
    if "wsclean" in body:
        m = re.match(r"(\S+)\s+(\S+)\s+wsclean\s+(\S+)\s+\[([^\]]*)\]\s+(\S+)\s+(\S+)", body)
        if m is None:
            raise ValueError(f"bad flux: {body!r}")
        coeffs = [float(c) for c in m[4].replace(",", " ").split()]
        return name.split("|")[0].strip("* "), angle(ra, True), angle(dec, False), "wsclean", float(m[1]), float(m[2]), float(m[3]), coeffs, m[5].lower() == "true", float(m[6])
    numbers = [float(x) for x in body.split()]
    if len(numbers) < 3:
        raise ValueError(f"bad flux: {body!r}")
    return name.split("|")[0].strip("* "), angle(ra, True), angle(dec, False), "poly", numbers[0], numbers[1], None, numbers[2:], True, 1e6


def component_flux(components: DataFrame, channels: DataFrame) -> DataFrame:
    """(comp, chan, flux): zero out of the component's band.  Both sides are small dimensions."""
    rows = components.crossJoin(F.broadcast(channels))
    mhz = F.col("freq_hz") / 1e6
    base = F.aggregate(F.reverse("coeffs"), F.lit(0.0), lambda acc, a: acc * F.log10(F.col("freq_hz") / 1e6) + a)
    x = F.when(F.col("is_log"), F.log(F.col("freq_hz") / F.col("ref_hz"))).otherwise(F.col("freq_hz") / F.col("ref_hz") - 1)
    poly = F.aggregate(F.reverse("coeffs"), F.lit(0.0), lambda acc, a: (acc + a) * x)
    wsclean = F.when(F.col("is_log"), F.col("s0") * F.exp(poly)).otherwise(F.col("s0") + poly)
    flux = F.when(F.col("kind") == "poly", F.pow(F.lit(10.0), base)).otherwise(wsclean)
    return rows.select("comp", "ra", "dec", "chan", "freq_hz", F.when((mhz >= F.col("fmin_mhz")) & (mhz <= F.col("fmax_mhz")), flux).otherwise(F.lit(0.0)).alias("flux"))


#: Baselines times components whose phases are held at a time.
CELLS = 1 << 20


def model_visibilities(components: DataFrame, channels: DataFrame, baselines: DataFrame, ra0: float, dec0: float) -> DataFrame:
    """Sum over components of S exp(2 pi i delay freq) per (dump, baseline, chan).

    ``baselines``: dump, ant1, ant2, u, v, w in metres.  The sky (fluxes and directions per channel, a small
    dimension) goes to every task, which turns each batch of baselines into one batch per channel.
    """
    flux = component_flux(components, channels)
    l, m, n = keys.sin_projection(F.col("ra"), F.col("dec"), F.lit(ra0), F.lit(dec0))
    listed = (F.collect_list(F.coalesce(x, F.lit(float("nan")))).alias(c) for c, x in (("l", l), ("m", m), ("n", n - 1), ("flux", F.col("flux"))))
    sky = [(r["chan"], r["freq_hz"], np.array([r["l"], r["m"], r["n"]]), np.array(r["flux"]), r["known"]) for r in flux.groupBy("chan", "freq_hz").agg(*listed, (F.count(l + m + n + F.col("flux")) == F.count("*")).alias("known")).collect()]
    names = ["dump", "ant1", "ant2"]
    schema = ", ".join([*(f"`{c}` {baselines.schema[c].dataType.simpleString()}" for c in names), "chan bigint", "re double", "im double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uvw = [batch.column(c) for c in "uvw"]
            null = np.any([np.asarray(x.is_null()) for x in uvw], axis=0)
            metres = np.stack([x.to_numpy(zero_copy_only=False).astype(float) for x in uvw], axis=1)
            for chan, freq, lmn, size, known in sky:
                total, per = np.empty((2, len(metres))), max(1, CELLS // len(size))
                for k in range(0, len(metres), per):
                    angle = metres[k : k + per] @ lmn * (2 * np.pi * freq / LIGHT)
                    total[0, k : k + per], total[1, k : k + per] = np.cos(angle) @ size, np.sin(angle) @ size
                unknown = null if known else np.ones(len(metres), dtype=bool)
                values = [pa.array(x, mask=unknown if unknown.any() else None) for x in total]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.full(len(metres), chan, dtype=np.int64)), *values], [*names, "chan", "re", "im"])

    made = baselines.select(*names, *(F.col(c).cast("double") for c in "uvw")).mapInArrow(run, schema)
    return made.withColumn("chan", F.col("chan").cast(channels.schema["chan"].dataType))


def is_point(components: DataFrame, ra0: float, dec0: float, arcsec: float = 8.0) -> DataFrame:
    """One row: whether the model is a single component near the phase centre."""
    apart = keys.haversine_deg(F.col("ra"), F.col("dec"), F.lit(ra0), F.lit(dec0)) * 3600
    return components.agg(((F.count("*") == 1) & (F.max(apart) <= arcsec)).alias("is_point"))


def read_components(spark: SparkSession, path: str) -> DataFrame:
    """Component table of the model files at ``path`` (one line per component)."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            rows = []
            for value, model in zip(pdf.value, pdf.model, strict=True):
                c = parse_component(value)
                if c is not None:
                    rows.append((model, 0, *c))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in COMPONENT.split(", ")])

    lines = spark.read.text(path).select("value", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("model"))
    return lines.mapInPandas(run, COMPONENT)

"""Report tables: the queries behind a calibration report (rendering is left to the reader).

Each function takes the solution table (product, time, target, chan, pol, ant, re, im or
delay, snr) or a summary table and returns a small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import cplx, keys
from lodestone.operators import robust


def value_or_unknown(attributes: Column, key: str) -> Column:
    """Attribute by key from a map, 'unknown' if absent."""
    return F.coalesce(F.element_at(attributes, key), F.lit("unknown"))


def units(tags: Column, has_model: Column, has_flux: Column) -> Column:
    cal = keys.any_tag_like(tags, "bpcal") | keys.any_tag_like(tags, "bfcal")
    return F.when((cal & has_model) | has_flux, "Jy").otherwise("Counts")


def target_groups(targets: DataFrame) -> DataFrame:
    """Booleans of the four overlapping groups; a pure target is no calibrator."""
    t = F.col("tags")
    gain, pol, bp = (keys.any_tag_like(t, x) for x in ("gaincal", "polcal", "bpcal"))
    bp = bp | keys.any_tag_like(t, "bfcal")
    return targets.withColumns({"is_bp": bp, "is_gain": gain, "is_pol": pol, "is_target": keys.has_tag(t, "target") & ~(gain | pol | bp)})


def delay_table(delays: DataFrame, ants: Sequence[int]) -> DataFrame:
    """Delays in ns: a row per time and polarisation, a column per antenna."""
    ns = F.round(cplx.clean(F.col("delay")) * 1e9, 3)
    return delays.groupBy("time", "pol").pivot("ant", list(ants)).agg(F.first(ns))


def amp_phase(solutions: DataFrame) -> DataFrame:
    return solutions.withColumn("amp", cplx.amplitude(cplx.col())).withColumn("phase", cplx.phase_deg(cplx.col()))


def bandpass_counts(b: DataFrame) -> DataFrame:
    """Per pol and antenna: solutions with any valid channel, and whether all are empty."""
    per = b.groupBy("time", "pol", "ant").agg(F.bool_or(cplx.clean(F.col("re")).isNotNull()).alias("valid"))
    return per.groupBy("pol", "ant").agg(F.count_if("valid").alias("n_solutions"), F.bool_and(~F.col("valid")).alias("all_bad"))


def snr_table(solutions: DataFrame, limit: float = 10.0) -> DataFrame:
    """Quartiles of the SNR over antennas, and antennas below the limit, per product, time and pol."""
    by = ["product", "time", "pol"]
    return robust.quartiles(solutions, by).join(robust.low_snr_count(solutions, by, limit), by)


def spectrum(summary: DataFrame, fluxes: DataFrame) -> DataFrame:
    """Amplitude and phase, flagged and zero cells hidden, scaled by the target's measured flux if there is one."""
    shown = (F.col("flags") == 0) & ((F.col("re") != 0) | (F.col("im") != 0))
    joined = summary.join(fluxes.select("target", F.col("flux")), "target", "left").withColumn("_f", F.coalesce("flux", F.lit(1.0)))
    amp = F.when(shown, cplx.amplitude(cplx.col()) * F.col("_f"))
    return joined.withColumn("amp", amp).withColumn("phase", F.when(shown, cplx.phase_deg(cplx.col()))).drop("_f", "flux")


def common_units(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.when(F.bool_and(F.col("units") == "Jy"), "Jy").otherwise("arb").alias("units"))


def uv_distance(rows: DataFrame, light: float = 299792458.0) -> DataFrame:
    """Baseline length in wavelengths from u, v in metres."""
    return rows.withColumn("uv_wavelengths", F.hypot("u", "v") * F.col("freq_hz") / light)


def flag_table(flags: DataFrame, antennas: DataFrame) -> DataFrame:
    """Flagged percentage per channel block and baseline, with the baseline's length to order by."""
    a, b = (antennas.select(F.col("ant").alias(f"ant{k}"), *(F.col(c).alias(f"{c}{k}") for c in "enu")) for k in (1, 2))
    length = F.sqrt(sum(F.pow(F.col(f"{c}1") - F.col(f"{c}2"), 2) for c in "enu"))
    pct = flags.groupBy("block", "pol", "ant1", "ant2").agg((100 * F.sum("n_flagged") / F.sum("n")).alias("flag_pct"))
    return pct.join(a, "ant1").join(b, "ant2").select("block", "pol", "ant1", "ant2", length.alias("length"), "flag_pct")


def refant_labels(rows: DataFrame, names: DataFrame, ref: int) -> DataFrame:
    """Name of the other antenna of the reference antenna's baselines."""
    other = F.when(F.col("ant1") == ref, F.col("ant2")).otherwise(F.col("ant1")).alias("ant")
    kept = rows.where((F.col("ant1") == ref) != (F.col("ant2") == ref)).select("ant1", "ant2", other)
    return kept.join(names, "ant").select("ant1", "ant2", "name")


def metadata(attributes: DataFrame) -> DataFrame:
    """One JSON text per capture block from a map of attributes, keys in order."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries("attributes")))
    return attributes.select("cb", F.to_json(ordered).alias("json"))


def summary(rows: DataFrame) -> DataFrame:
    """Start, counts and antennas (a short list) of each capture block; rows: cb, time, dump, chan, ant1."""
    ants = F.array_join(F.array_sort(F.collect_set(F.col("ant1").cast("string"))), ",")
    return rows.groupBy("cb").agg(F.min("time").alias("first_time"), F.count_distinct("dump").alias("n_dumps"), F.count_distinct("chan").alias("n_chans"), ants.alias("antennas"))


def before_nth(log: DataFrame, marks: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, ts: str) -> DataFrame:
    """Rows of the log before the n-th mark of their key; all of them where there are fewer marks."""
    w = Window.partitionBy(*keys).orderBy(*order)
    stop = marks.withColumn("_k", F.row_number().over(w)).where(F.col("_k") == n).select(*keys, F.col(ts).alias("_stop"))
    return log.join(stop, list(keys), "left").where(F.col("_stop").isNull() | (F.col(ts) < F.col("_stop"))).drop("_stop")


def states_json(rows: DataFrame, keys: Sequence[str], dump: str, state: str) -> DataFrame:
    """JSON object of dump and state name per key, dumps in order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(dump), F.col(state))))
    return rows.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias("states"))

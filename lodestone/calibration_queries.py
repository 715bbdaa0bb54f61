"""Queries of the solvers and of the whole reduction, over the driver's tables, with their SQL.

``observation`` (from ``lineitem``) is a table of visibilities whose values are those of unit
sources seen with known delays, bandpasses and gains; a scan is 500 orders, so scans grow with
the table.  The SQL gives what a solver must recover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import cplx
from lodestone.operators import average, model, pointing, report, rfi, solve
from lodestone.plans import pipeline, reduction
from lodestone.queries import _r, query, sens, vis
from lodestone.sources.scratch import shared_path, written
from lodestone.streaming import batcher, incremental

ANTS, REF = 8, 0
#: Gains in intervals of about 170 dumps, which divide a scan of 500 in three.
SETTINGS = reduction.Settings(g_solint=170)
#: Directions (cosine, sine) of the gains, by antenna modulo 4.
TURNS = ((1.0, 0.0), (0.6, 0.8), (0.8, -0.6), (0.28, 0.96))

_TURN_SQL = "[1.0, 0.6, 0.8, 0.28][CAST({a} % 4 AS INTEGER) + 1] AS c, [0.0, 0.8, -0.6, 0.96][CAST({a} % 4 AS INTEGER) + 1] AS s".format(a="ant")
_TRUTH = f"""WITH scans AS (SELECT DISTINCT CAST(l_orderkey // 500 AS INTEGER) AS scan FROM lineitem), a AS (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS ant),
p(pol, step) AS (VALUES ('h', 0.0), ('v', 0.5)), truth AS (SELECT scan, pol, ant, (1 + 0.5 * (scan % 3)) * (1 + 0.25 * (ant % 4) + step) AS amp, {_TURN_SQL}, 0.5 * ant * (1 + 2 * step) AS delay_ns FROM scans, a, p)"""


def channels(spark: SparkSession) -> DataFrame:
    return spark.range(1, 8).select(F.col("id").cast("int").alias("chan"), (F.lit(1284e6) + (F.col("id") - 4) * 1e6).alias("freq_hz"))


def _gain(ant: Column, pol: Column) -> tuple[Column, Column, Column]:
    """Gain but for the scan's factor and the bandpass, and delay (s), of an antenna."""
    step = F.when(pol == "v", 0.5).otherwise(0.0)
    amp = 1 + 0.25 * (ant % 4) + step
    c, s = (F.element_at(F.array(*(F.lit(t[k]) for t in TURNS)), (ant % 4 + 1).cast("int")) for k in (0, 1))
    return amp * c, amp * s, 0.5e-9 * ant * (1 + 2 * step)


def observation(spark: SparkSession, sf: str) -> DataFrame:
    """scan, ts, dump, chan, pol, ant1, ant2, re, im, flags, weight; every 11th dump is flagged and wrong."""
    rows = vis(spark, sf).withColumn("scan", F.floor(F.col("dump") / 500).cast("int")).withColumn("bad", F.col("dump") % 11 == 3)
    (r1, i1, k1), (r2, i2, k2) = (_gain(F.col(a), F.col("pol")) for a in ("ant1", "ant2"))
    band = 1.0
    for a in ("ant1", "ant2"):
        band = band * (1 + (F.col("chan") - 4) * 0.05 * (1 - 2 * (F.col(a) % 2)))
    freq = F.lit(1284e6) + (F.col("chan") - 4) * 1e6
    g = cplx.mul(cplx.mul((r1, i1), cplx.conj((r2, i2))), cplx.delay_phasor(k1 - k2, freq))
    size = F.pow(1 + 0.5 * (F.col("scan") % 3), 2) * band * F.when(F.col("bad"), 1000.0).otherwise(1.0)
    return rows.select("scan", (100 + 4.0 * F.col("dump")).alias("ts"), "dump", "chan", "pol", "ant1", "ant2", (g[0] * size).alias("re"), (g[1] * size).alias("im"), F.col("bad").cast("int").alias("flags"), "weight")


def scans(observed: DataFrame) -> DataFrame:
    """Every fourth scan is a target; the others are a beamformer, a three-fold and a gain calibrator."""
    times = observed.groupBy("scan").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    tags = F.element_at(F.array(*(F.split(F.lit(t), " ") for t in ("bfcal", "delaycal bpcal gaincal", "gaincal", "target"))), (F.col("scan") % 4 + 1).cast("int"))
    return times.select("scan", F.col("scan").alias("batch"), F.concat(F.lit("s"), F.col("scan").cast("string")).alias("target"), tags.alias("tags"), "t0", "t1")


def _reduced(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    observed = observation(spark, sf)
    return reduction.reduce_scans(observed.drop("scan"), scans(observed), channels(spark), ANTS, REF, SETTINGS)


@query(f"{_TRUTH} SELECT scan, pol, ant, round(delay_ns, 3) + 0.0 AS delay_ns FROM truth WHERE scan % 4 < 2")
def solve_delay(spark, sf):
    """K of the delay and beamformer calibrators, relative to the reference antenna."""
    observed = observation(spark, sf)
    k = reduction.solve_delays(observed.where("ant1 <> ant2"), scans(observed), channels(spark), ANTS, REF)
    return k.select("scan", "pol", "ant", (_r(F.col("delay") * 1e9, 3) + 0.0).alias("delay_ns"))


@query(f"{_TRUTH}, c AS (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS chan) SELECT scan, chan, pol, ant, round(1 + (chan - 4) * 0.05 * (1 - 2 * (ant % 2)), 3) AS re, 0.0 AS im FROM truth, c WHERE scan % 4 < 2")
def solve_bandpass(spark, sf):
    """B of the bandpass and beamformer calibrators, with a mean of one."""
    b = _reduced(spark, sf)["B"]
    return b.select("scan", "chan", "pol", "ant", _r("re", 3).alias("re"), (_r("im", 3) + 0.0).alias("im"))


@query(f"""{_TRUTH}, d AS (SELECT CAST(l_orderkey // 500 AS INTEGER) AS scan, l_orderkey AS dump FROM lineitem WHERE l_suppkey % 8 <> l_partkey % 8),
n AS (SELECT scan, min(dump) AS d0, max(dump) - min(dump) + 1 AS n FROM d GROUP BY scan), q AS (SELECT scan, d0, CASE WHEN scan % 4 = 0 OR n <= 170 THEN n ELSE ceil(n / greatest(1, round(n / 170.0))) END AS per FROM n),
i AS (SELECT DISTINCT scan, CAST(floor((dump - d0) / per) AS INTEGER) AS solint FROM d JOIN q USING (scan))
SELECT scan, solint, pol, ant, round(amp * c, 3) + 0.0 AS re, round(amp * s, 3) + 0.0 AS im FROM truth JOIN i USING (scan) WHERE scan % 4 < 3""")
def solve_gain(spark, sf):
    """G in even intervals of the gain calibrators and in one of the beamformer calibrators."""
    g = _reduced(spark, sf)["G"]
    return g.select("scan", "solint", "pol", "ant", (_r("re", 3) + 0.0).alias("re"), (_r("im", 3) + 0.0).alias("im"))


_APPLIED = """WITH o AS (SELECT CAST(l_orderkey // 500 AS INTEGER) AS scan, l_linenumber AS chan FROM lineitem WHERE l_orderkey % 11 <> 3)
SELECT scan, chan, count(*) AS n, round(CASE WHEN scan % 4 = 3 THEN pow((1 + 0.5 * (scan % 3)) / (1 + 0.5 * ((scan - 1) % 3)), 2) ELSE 1 END, 3) AS re, 0.0 AS im FROM o GROUP BY scan, chan"""


@query(_APPLIED)
def calibrate_apply(spark, sf):
    """The whole reduction: calibrators come out as one, a target by the gains of the scan before it."""
    return _means(_reduced(spark, sf)["corrected"])


def _means(corrected: DataFrame) -> DataFrame:
    flat = corrected.where("flags = 0").groupBy("scan", "chan").agg(F.count("*").alias("n"), _r(F.avg("re"), 3).alias("re"), (_r(F.avg("im"), 3) + 0.0).alias("im"))
    return flat.withColumn("scan", F.col("scan").cast("int"))


@query(_APPLIED)
def incremental_apply(spark, sf):
    """The same from a stream in two parts, the second of which begins with a target that takes the gains of the first."""
    rows = observation(spark, sf)
    known = written(scans(rows).select("scan", "batch", "target", "tags"), "scans")
    told = rows.join(known, "scan").withColumn("cb", F.lit("cb"))
    newest = known.agg(F.max("scan")).first()[0] or 0
    cut = min(newest, newest // 8 * 4 + 3)
    store = incremental.Store(spark, shared_path(spark, "store")).open()
    source, checkpoint = shared_path(spark, "observation"), shared_path(spark, "stream")
    step = incremental.reducer(store, channels(spark), ANTS, REF, SETTINGS)
    for part in (F.col("scan") < cut, F.col("scan") >= cut):
        told.where(part).write.mode("append").parquet(source)
        incremental.reduce_stream(spark.readStream.schema(told.schema).parquet(source), step, checkpoint).awaitTermination()
    return _means(store.read("corrected"))


@query("""WITH e AS (SELECT unnest([ant1, ant2]) AS ant, pol, ant1, ant2, flags, re, im FROM vis WHERE ant1 <> ant2),
b AS (SELECT ant, pol, ant1, ant2, avg(CASE WHEN flags = 0 THEN re END) AS mr, avg(CASE WHEN flags = 0 THEN im END) AS mi, avg(CASE WHEN flags = 0 THEN re * re + im * im END) AS pw FROM e GROUP BY ALL),
q AS (SELECT ant, avg((mr * mr + mi * mi) / pw) AS quality FROM b GROUP BY ant) SELECT ant FROM q ORDER BY quality DESC, ant LIMIT 1""")
def reference_antenna(spark, sf):
    return solve.reference_antenna(vis(spark, sf))


@query("""WITH s AS (SELECT pol, ant1, ant2, chan, coalesce(sum(re * weight) FILTER (WHERE flags = 0) / sum(weight) FILTER (WHERE flags = 0), 0) AS re, coalesce(sum(im * weight) FILTER (WHERE flags = 0) / sum(weight) FILTER (WHERE flags = 0), 0) AS im FROM vis WHERE ant1 <> ant2 GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY pol, ant1, ant2 ORDER BY chan) - 1 AS j, 8 * count(*) OVER (PARTITION BY pol, ant1, ant2) AS n FROM s), k AS (SELECT *, unnest(range(0, n)) AS k FROM p),
t AS (SELECT pol, ant1, ant2, k, sqrt(pow(sum(re * cos(2 * pi() * j * k / n) + im * sin(2 * pi() * j * k / n)), 2) + pow(sum(im * cos(2 * pi() * j * k / n) - re * sin(2 * pi() * j * k / n)), 2)) AS a FROM k GROUP BY pol, ant1, ant2, k),
b AS (SELECT pol, ant1, ant2, max(a) / quantile_cont(a, 0.5) AS peak FROM t GROUP BY ALL), q AS (SELECT ant, avg(peak) AS quality FROM (SELECT unnest([ant1, ant2]) AS ant, peak FROM b) GROUP BY ant)
SELECT ant, round(quality, 5) AS quality, row_number() OVER (ORDER BY quality DESC, ant) AS place FROM q""")
def antenna_ranking(spark, sf):
    """All antennas from the best reference on, by the delay transforms of their baselines."""
    return solve.antenna_ranking(vis(spark, sf), channels(spark)).select("ant", _r("quality", 5).alias("quality"), "place")


@query("SELECT CAST(l_orderkey // 500 AS INTEGER) AS scan, CAST(l_suppkey % 8 AS INTEGER) AS ant, round(CAST((l_orderkey // 500) % 5 - 2 AS DOUBLE), 3) + 0.0 AS delay_ns FROM lineitem GROUP BY ALL")
def solve_cross_delay(spark, sf):
    """Cross-hand delay per scan and antenna of spectra with a known slope."""
    rows = observation(spark, sf).groupBy("scan", F.col("ant1").alias("ant"), "chan").agg(F.sum("weight").alias("weight")).join(channels(spark), "chan")
    re, im = cplx.delay_phasor((F.col("scan") % 5 - 2) * 1e-9, F.col("freq_hz"))
    spectra = rows.select("scan", "ant", "chan", "weight", (3 * re).alias("re"), (3 * im).alias("im"))
    out = solve.solve_cross_delay(spectra, channels(spark), ["scan", "ant"], "h")
    return out.select("scan", "ant", (_r(F.col("delay") * 1e9, 3) + 0.0).alias("delay_ns"))


@query("""SELECT dump, chan, ant1, ant2, pol, round(sum((re * cos(radians(10)) + im * sin(radians(10))) / sqrt(re * re + im * im)), 6) AS re,
 round(sum((im * cos(radians(10)) - re * sin(radians(10))) / sqrt(re * re + im * im)), 6) AS im FROM vis GROUP BY ALL""")
def cross_phase_sky(spark, sf):
    """Cross-hand phases turned to the sky by a spline of the frequency (here even, ten degrees)."""
    unit = solve.cross_phase(vis(spark, sf).join(channels(spark), "chan").select("dump", "chan", "freq_hz", "ant1", "ant2", "pol", "re", "im"))
    sky = solve.rotate_by_spline(unit, [800.0] * 4 + [1800.0] * 4, [10.0] * 4, 3, True)
    return sky.groupBy("dump", "chan", "ant1", "ant2", "pol").agg(_r(F.sum("re")).alias("re"), _r(F.sum("im")).alias("im"))


@query("""WITH bl AS (SELECT DISTINCT dump, ant1, ant2 FROM vis), c AS (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS chan), k AS (SELECT unnest(range(0, 3)) AS k),
x AS (SELECT dump, ant1, ant2, chan, 1284e6 + (chan - 4) * 1e6 AS f, k + 1 AS s0, radians(k * 15 / 3600.0) AS ra, radians(k * 10 / 3600.0) AS de, 100.0 * (ant1 - ant2) + 0.01 * (dump % 97) AS u, 70.0 * (ant2 - ant1) AS v, 0.5 * ant1 AS w FROM bl, c, k),
y AS (SELECT *, s0 * exp(-0.7 * ln(f / 1284e6)) AS s, (u * cos(de) * sin(ra) + v * sin(de) + w * (cos(de) * cos(ra) - 1)) * f / 299792458.0 AS t FROM x)
SELECT dump, ant1, ant2, chan, round(sum(s * cos(2 * pi() * t)), 4) + 0.0 AS re, round(sum(s * sin(2 * pi() * t)), 4) + 0.0 AS im FROM y GROUP BY ALL""")
def sky_model(spark, sf):
    """Model visibilities of three sources on the table's baselines."""
    rows = [("m", k, *model.parse_component(f"s{k}, radec, 0:0:{k}, 0:0:{10 * k}, 800 2000 wsclean {k + 1}.0 [-0.7] true 1284e6")) for k in range(3)]
    bl = vis(spark, sf).select("dump", "ant1", "ant2").distinct()
    u, v, w = 100.0 * (F.col("ant1") - F.col("ant2")) + 0.01 * (F.col("dump") % 97), 70.0 * (F.col("ant2") - F.col("ant1")), 0.5 * F.col("ant1")
    out = model.model_visibilities(spark.createDataFrame(rows, model.COMPONENT), channels(spark), bl.withColumns({"u": u, "v": v, "w": w}), 0.0, 0.0)
    return out.select("dump", "ant1", "ant2", "chan", (_r("re", 4) + 0.0).alias("re"), (_r("im", 4) + 0.0).alias("im"))


@query("""SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS ant, l_linenumber AS chunk, CASE WHEN l_linestatus = 'O' THEN 'h' ELSE 'v' END AS pol, round(0.1 * (l_suppkey % 3), 4) AS x0, round(-0.1 * (l_linenumber % 3), 4) + 0.0 AS y0,
 round(0.8, 4) AS wx, round(0.6, 4) AS wy, CAST(2 + l_linenumber AS DOUBLE) AS height FROM lineitem""")
def beam_fit(spark, sf):
    """Beams of every antenna (supplier), frequency chunk and polarisation from gains at offsets."""
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    x, y = (F.col("l_partkey") % 5 - 2) * 0.5, (F.col("l_orderkey") % 5 - 2) * 0.5
    amp = (2 + F.col("l_linenumber")) * F.exp(-0.5 * (F.pow((x - 0.1 * (F.col("l_suppkey") % 3)) / 0.8, 2) + F.pow((y + 0.1 * (F.col("l_linenumber") % 3)) / 0.6, 2)))
    pol = F.when(F.col("l_linestatus") == "O", "h").otherwise("v")
    fits = pointing.beam_fits(t.select(F.col("l_suppkey").cast("int").alias("ant"), F.col("l_linenumber").alias("chunk"), pol.alias("pol"), x.alias("x"), y.alias("y"), amp.alias("amp")))
    return fits.where("valid").select("ant", "chunk", "pol", *((_r(c, 4) + 0.0).alias(c) for c in ("x0", "y0", "wx", "wy", "height")))


@query(f"{_TRUTH} SELECT scan AS time, pol, {', '.join(f'round(max(CASE WHEN ant = {a} THEN delay_ns END), 3) + 0.0 AS \"{a}\"' for a in range(8))} FROM truth WHERE scan % 4 < 2 GROUP BY scan, pol")
def report_delays(spark, sf):
    """Delays in ns, a column per antenna."""
    k = solve_delay(spark, sf).select(F.col("scan").alias("time"), "pol", "ant", (F.col("delay_ns") / 1e9).alias("delay"))
    return report.delay_table(k, range(ANTS))


@query("""SELECT key AS product, CAST(ant % 10 AS INTEGER) AS time, 'h' AS pol, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
 count(*) FILTER (WHERE value < 10) AS n_low FROM sens GROUP BY ALL""")
def report_snr(spark, sf):
    rows = sens(spark, sf).select(F.col("key").alias("product"), (F.col("ant") % 10).cast("int").alias("time"), F.lit("h").alias("pol"), F.col("value").alias("snr"))
    return report.snr_table(rows).select("product", "time", "pol", *(_r(q).alias(q) for q in ("q25", "q50", "q75")), "n_low")


@query("""SELECT l_orderkey AS dump, l_linenumber AS chan, CASE WHEN bool_or(l_returnflag = 'R') THEN 16 WHEN l_orderkey % 11 = 3 OR (l_orderkey % 97 = 5 AND l_linenumber = 2) THEN 64 ELSE 0 END AS flags FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def rfi_sumthreshold(spark, sf):
    """Interference of a baseline per 2,048 dumps with noise and a bandpass: bursts over whole dumps and lone spikes; known bad cells stay as they are."""
    t = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max((F.col("l_returnflag") == "R")).alias("bad"))
    burst, spike = F.col("l_orderkey") % 11 == 3, (F.col("l_orderkey") % 97 == 5) & (F.col("l_linenumber") == 2)
    amp = 2 + 0.1 * F.col("l_linenumber") + 0.0004 * F.col("l_quantity") + F.when(burst | spike, 3.0).otherwise(0.0)
    bad = F.col("bad")
    rows = t.select(
        F.floor(F.col("l_orderkey") / 2048).cast("int").alias("scan"), F.lit("h").alias("pol"), F.lit(0).alias("ant1"), F.lit(1).alias("ant2"), F.col("l_orderkey").alias("dump"), F.col("l_linenumber").alias("chan"),
        F.when(bad, 1000.0).otherwise(amp).alias("re"), F.lit(0.0).alias("im"), F.when(bad, 16).otherwise(0).alias("flags"),
    )
    flagger = rfi.Flagger(spike_freq=0.0)
    # A scan of few channels is one tile: no cell is read twice.
    return pipeline.flag_rows(rows, flagger=flagger, dumps=2048).select("dump", "chan", "flags")


@query("""WITH e AS (SELECT CAST(user_id AS INTEGER) AS g, event_id AS dump, CASE event_type WHEN 'purchase' THEN 'await_pipeline' WHEN 'signup' THEN 'slew' ELSE event_type END AS activity FROM events),
o AS (SELECT *, lag(dump) OVER w AS prev, lag(activity) OVER w AS old FROM e WINDOW w AS (PARTITION BY g ORDER BY dump)),
n AS (SELECT *, sum(CASE WHEN old NOT IN ('slew', 'await_pipeline') THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY dump) AS part FROM o),
r AS (SELECT g, part, min(coalesce(prev + 1, dump)) AS first, min(dump) AS opened, max(dump) AS last, arg_min(activity, dump) AS activity FROM n GROUP BY g, part),
b AS (SELECT *, CAST(coalesce(sum((last - first) // 30 + 1) OVER (PARTITION BY g ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM r),
d AS (SELECT g, base, first, unnest(range(first, last + 1)) AS dump FROM b)
SELECT 'cb' AS cb, d.g AS chan_group, base + (d.dump - first) // 30 AS batch, d.dump, CASE WHEN e.dump IS NULL THEN 8 ELSE 0 END AS flags, '' AS payload, CAST(0 AS BIGINT) AS too_late, '' AS control FROM d LEFT JOIN e ON d.g = e.g AND d.dump = e.dump
UNION ALL SELECT 'cb', g, base - 1, opened, 0, '', 0, 'sync' FROM b WHERE part > 0 AND activity = 'await_pipeline'""")
def stream_batches(spark, sf):
    """The event log as a stream of heaps, ended by a stop heap for each group: batches of up to 30 dumps, broken by activity, control rows where the pipeline is awaited; closed batches are written as runs and read back as dumps."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    activity = F.when(F.col("event_type") == "purchase", batcher.AWAIT).when(F.col("event_type") == "signup", "slew").otherwise(F.col("event_type"))
    heaps = e.select(
        F.lit("cb").alias("cb"), F.col("user_id").cast("int").alias("chan_group"), F.col("event_id").alias("dump"), activity.alias("activity"), F.col("event_id").cast("double").alias("activity_time"),
        F.lit("gaincal").alias("tags"), F.lit(False).alias("is_stop"), F.lit(0).alias("flags"), F.lit(None).cast("string").alias("payload"), F.col("event_id").cast("bigint").alias("seq"),
    )
    stops = heaps.select("cb", "chan_group").distinct().withColumn("is_stop", F.lit(True))
    log = written(heaps.unionByName(stops, allowMissingColumns=True), "heaps")
    stream = spark.readStream.schema(log.schema).parquet(log.inputFiles()[0].rsplit("/", 1)[0])
    out = shared_path(spark, "batches")
    batcher.write_batches(batcher.closed_runs(stream, 30), out, shared_path(spark, "stream")).awaitTermination()
    return batcher.dump_rows(spark.read.schema(batcher.RUNS).parquet(out), "")

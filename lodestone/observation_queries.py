"""Queries of ingest, geometry, summaries and control rows, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.functions import cplx
from lodestone.operators import astro, average, ingest, report, robust, sensors
from lodestone.queries import _epoch, _r, query, sens, vis
from lodestone.sources.scratch import dealt

#: Any site (degrees).
LATITUDE, LONGITUDE = -30.0, 20.0

_SKY = f"""lst AS (SELECT *, (280.46061837 + {LONGITUDE} + (t / 86400.0 - 10957.5) * 360.98564736629) AS raw FROM base),
h AS (SELECT *, radians(raw - 360 * floor(raw / 360) - ra) AS h, radians(de) AS d, radians({LATITUDE}) AS p FROM lst)"""


# --- geometry -------------------------------------------------------------------------------------


@query(f"""WITH base AS (SELECT o_orderkey AS k, CAST(o_custkey % 7 AS INTEGER) AS target, o_orderkey * 4.0 + 1.4e9 AS t, (o_custkey % 7) * 50.0 AS ra, -60.0 + (o_custkey % 7) * 10 AS de FROM orders), {_SKY}
SELECT k, target, round(degrees(asin(sin(d) * sin(p) + cos(d) * cos(h) * cos(p))), 6) AS el FROM h""")
def elevation(spark, sf):
    """Elevation of each target at the times it was observed."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    n = F.col("o_custkey") % 7
    _, el = astro.az_el(F.col("o_orderkey") * 4.0 + 1.4e9, n * 50.0, F.lit(-60.0) + n * 10, LATITUDE, LONGITUDE)
    return o.select(F.col("o_orderkey").alias("k"), n.cast("int").alias("target"), _r(el).alias("el"))


_PLACE = f"""WITH base AS (SELECT o_orderkey AS k, o_orderkey * 40000.0 + 0.9e9 AS t, 10 + (o_custkey % 7) * 50.0 AS ra, -60.0 + (o_custkey % 7) * 17 AS de FROM orders),
c AS (SELECT *, (t / 86400.0 - 10957.5) / 36525.0 AS c FROM base),
p AS (SELECT *, radians(((0.017998 * c + 0.30188) * c + 2306.2181) * c / 3600 + ra) AS a0, ((0.018203 * c + 1.09468) * c + 2306.2181) * c / 3600 AS z, radians(((-0.041833 * c - 0.42665) * c + 2004.3109) * c / 3600) AS th, radians(de) AS d0,
 radians(125.04452 - 1934.136261 * c) AS nd, radians(280.4665 + 36000.7698 * c) AS sl, radians(218.3165 + 481267.8813 * c) AS ml, radians(357.52911 + (35999.05029 - 0.0001537 * c) * c) AS m, radians(102.93735 + (1.71946 + 0.00046 * c) * c) AS q, 0.016708634 - 0.000042037 * c AS ec FROM c),
u AS (SELECT *, radians(degrees(atan2(cos(d0) * sin(a0), cos(th) * cos(d0) * cos(a0) - sin(th) * sin(d0))) + z) AS a, asin(sin(th) * cos(d0) * cos(a0) + cos(th) * sin(d0)) AS d,
 (-17.20 * sin(nd) - 1.32 * sin(2 * sl) - 0.23 * sin(2 * ml) + 0.21 * sin(2 * nd)) / 3600 AS psi, (9.20 * cos(nd) + 0.57 * cos(2 * sl) + 0.10 * cos(2 * ml) - 0.09 * cos(2 * nd)) / 3600 AS eps,
 radians(280.46646 + (36000.76983 + 0.0003032 * c) * c + (1.914602 - 0.004817 * c) * sin(m) + (0.019993 - 0.000101 * c) * sin(2 * m) + 0.000289 * sin(3 * m)) AS s FROM p),
w AS (SELECT *, radians(23 + 26 / 60.0 + 21.448 / 3600 - 46.8150 / 3600 * c + eps) AS o, 20.49552 / 3600 AS kap FROM u),
ap AS (SELECT k, t, psi, o, degrees(a) + (cos(o) + sin(o) * sin(a) * tan(d)) * psi - cos(a) * tan(d) * eps + kap / cos(d) * (ec * (cos(a) * cos(q) * cos(o) + sin(a) * sin(q)) - cos(a) * cos(s) * cos(o) - sin(a) * sin(s)) AS ra,
 degrees(d) + sin(o) * cos(a) * psi + sin(a) * eps + kap * (ec * (cos(q) * (sin(o) * cos(d) - cos(o) * sin(a) * sin(d)) + cos(a) * sin(d) * sin(q)) - cos(s) * (sin(o) * cos(d) - cos(o) * sin(a) * sin(d)) - cos(a) * sin(d) * sin(s)) AS de FROM w)"""


def _places(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    n = F.col("o_custkey") % 7
    return o.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") * 40000.0 + 0.9e9).alias("t"), (10 + n * 50.0).alias("ra"), (F.lit(-60.0) + n * 17).alias("de"))


@query(f"{_PLACE} SELECT k, round(ra - 360 * floor(ra / 360), 6) AS ra, round(de, 6) AS de FROM ap")
def apparent_places(spark, sf):
    """Places of date of the targets: precession, nutation and aberration."""
    ra, de = astro.apparent(F.col("t"), F.col("ra"), F.col("de"))
    return _places(spark, sf).select("k", _r(ra).alias("ra"), _r(de).alias("de"))


@query(f"""{_PLACE}, h AS (SELECT *, radians(280.46061837 + {LONGITUDE} + (t / 86400.0 - 10957.5) * 360.98564736629 + psi * cos(o) - ra) AS h, radians(de) AS d, radians({LATITUDE}) AS p FROM ap)
SELECT k, round(degrees(asin(sin(d) * sin(p) + cos(d) * cos(h) * cos(p))), 6) AS el FROM h""")
def apparent_elevation(spark, sf):
    """Elevation by apparent place and apparent sidereal time."""
    el = astro.apparent_az_el(F.col("t"), F.col("ra"), F.col("de"), LATITUDE, LONGITUDE)[1]
    return _places(spark, sf).select("k", _r(el).alias("el"))


@query(f"""WITH base AS (SELECT DISTINCT dump, ant1, ant2, chan, dump * 4.0 + 1.4e9 AS t, 40.0 AS ra, -25.0 AS de, (ant2 - ant1) * 30.0 AS e, (ant2 % 3 - ant1 % 3) * 50.0 AS n, (ant2 - ant1) * 0.5 AS u FROM vis), {_SKY},
x AS (SELECT *, -sin(p) * n + cos(p) * u AS x, e AS y, cos(p) * n + sin(p) * u AS z, (1284e6 + chan * 1e6) / 299792458.0 AS f FROM h)
SELECT dump, ant1, ant2, chan, round((sin(h) * x + cos(h) * y) * f, 4) + 0.0 AS u, round((-sin(d) * cos(h) * x + sin(d) * sin(h) * y + cos(d) * z) * f, 4) + 0.0 AS v, round((cos(d) * cos(h) * x - cos(d) * sin(h) * y + sin(d) * z) * f, 4) + 0.0 AS w FROM x""")
def uvw_wavelengths(spark, sf):
    """u, v, w of every baseline, time and channel in wavelengths."""
    b = vis(spark, sf).select("dump", "ant1", "ant2", "chan").distinct()
    apart = F.col("ant2") - F.col("ant1")
    parts = astro.uvw(F.col("dump") * 4.0 + 1.4e9, F.lit(40.0), F.lit(-25.0), apart * 30.0, (F.col("ant2") % 3 - F.col("ant1") % 3) * 50.0, apart * 0.5, LATITUDE, LONGITUDE)
    freq = F.lit(1284e6) + F.col("chan") * 1e6
    return b.select("dump", "ant1", "ant2", "chan", *((_r(astro.wavelengths(x, freq), 4) + 0.0).alias(n) for x, n in zip(parts, "uvw", strict=True)))


@query("SELECT p_partkey AS k, round(1.02 / tan(radians(p_size + 10.3 / (p_size + 5.11))) / 60 * (901.8 / 1010.0) * (283.0 / (273.0 + p_retailprice / 100)), 8) AS refraction FROM part")
def refraction(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    return p.select(F.col("p_partkey").alias("k"), _r(astro.refraction_deg(F.col("p_size"), F.lit(901.8), F.col("p_retailprice") / 100), 8).alias("refraction"))


# --- ingest and output ----------------------------------------------------------------------------


_ORDER = "o AS (SELECT ant1, ant2, row_number() OVER (ORDER BY ant1, ant2) - 1 AS idx, row_number() OVER (ORDER BY ant2 DESC, ant1) - 1 AS input_idx FROM (SELECT DISTINCT ant1, ant2 FROM vis))"


@query(f"""WITH {_ORDER}, b AS (SELECT dump, chan, idx, max(CASE WHEN flags <> 0 AND dump % 2 = 0 THEN 1 ELSE 0 END) AS bit FROM vis JOIN o USING (ant1, ant2) GROUP BY ALL)
SELECT dump, chan, idx // 8 AS byte, CAST(sum(bit * power(2, 7 - idx % 8)) AS INTEGER) AS value FROM b GROUP BY ALL""")
def excision_bytes(spark, sf):
    """Excision bits of the correlation products, eight to a byte; only every second dump is excised."""
    return _excision(spark, sf)


def _orders(spark, sf):
    """idx and input_idx of the correlation products (a small dimension)."""
    products = vis(spark, sf).select("ant1", "ant2").distinct()
    place = lambda *by: (F.row_number().over(Window.orderBy(*by)) - 1).cast("long")
    return products.select("ant1", "ant2", place("ant1", "ant2").alias("idx"), place(F.desc("ant2"), "ant1").alias("input_idx"))


def _excision(spark, sf):
    cells = dealt(vis(spark, sf).select("dump", "chan", "ant1", "ant2", "flags"), "dump")
    bits = cells.join(F.broadcast(_orders(spark, sf)), ["ant1", "ant2"]).withColumn("bit", ingest.excised(F.col("flags"), F.col("dump") % 2 == 0).cast("int"))
    return ingest.pack_bits(bits, ["dump", "chan"], "idx", "bit")


@query(f"""WITH {_ORDER} SELECT dump, chan, input_idx AS idx FROM vis JOIN o USING (ant1, ant2) WHERE flags <> 0 AND dump % 2 = 0 GROUP BY ALL""")
def excision_sent(spark, sf):
    """The packed bits unpacked and put back into the input's product order: the cells that are excised."""
    bits = ingest.unpack_bits(_excision(spark, sf), "idx", "bit")
    return ingest.restore_order(bits, F.broadcast(_orders(spark, sf).select("idx", "input_idx"))).where("bit = 1").select("dump", "chan", "idx")


@query("""WITH s AS (SELECT 'product_' || key AS key, epoch(ts) AS t, value AS v, event_id FROM sens)
SELECT key, ts, value, event_id FROM (SELECT key, t AS ts, v AS value, event_id FROM s UNION ALL SELECT key, t + 1, v + 1, event_id FROM s
UNION ALL SELECT replace(key, 'product_', 'product_SNR_'), t, v / 2, event_id FROM s WHERE event_id % 2 = 0 UNION ALL SELECT replace(key, 'product_', 'product_SNR_'), t + 1, v / 4, event_id FROM s WHERE event_id % 2 = 0)""")
def solution_sink(spark, sf):
    """Solution series as a row per time, their SNR (where there is one) under a key of its own."""
    s = sens(spark, sf).select(F.concat(F.lit("product_"), "key", F.lit("#"), F.col("event_id").cast("string")).alias("key"), _epoch("ts").alias("t"), "value", "event_id")
    series = s.select("key", F.array("t", F.col("t") + 1).alias("times"), F.array("value", F.col("value") + 1).alias("values"), F.when(F.col("event_id") % 2 == 0, F.array(F.col("value") / 2, F.col("value") / 4)).alias("snr"))
    rows = ingest.solution_rows(series)
    return rows.select(F.substring_index("key", "#", 1).alias("key"), "ts", "value", F.substring_index("key", "#", -1).cast("long").alias("event_id"))


@query("""WITH a AS (SELECT p_name AS key, p_brand AS value, CASE WHEN p_partkey % 3 > 0 THEN p_partkey * 1.0 END AS ts FROM part)
SELECT 'static' AS kind, key, value, NULL::DOUBLE AS ts FROM a WHERE ts IS NULL UNION ALL SELECT 'timestamped', key, value, ts FROM a WHERE ts IS NOT NULL UNION ALL SELECT 'missing', 'n_chans', NULL, NULL""")
def attribute_split(spark, sf):
    """Attributes without and with a time, and required keys that are missing."""
    a = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_name").alias("key"), F.col("p_brand").alias("value"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey") * 1.0).alias("ts"))
    static, timed, missing = ingest.split_attributes(a, ["n_chans"])
    kinds = [(static, "static"), (timed, "timestamped"), (missing, "missing")]
    frames = [d.withColumn("kind", F.lit(k)) for d, k in kinds]
    return frames[0].unionByName(frames[1], True).unionByName(frames[2], True).select("kind", "key", "value", "ts")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def subtable_lookup(spark, sf):
    return ingest.subtable(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))


@query("SELECT p_partkey AS k, 'param_' || (CASE WHEN p_size % 2 = 0 THEN 'k_bchan' ELSE 'g_bchan' END) AS key, CAST(p_size + (p_partkey % 4) * 1024 AS BIGINT) AS value FROM part")
def published_parameters(spark, sf):
    """A server's local channels as global ones under their published names."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    name = F.when(F.col("p_size") % 2 == 0, "k_bchan").otherwise("g_bchan")
    return p.select(F.col("p_partkey").alias("k"), F.concat(F.lit("param_"), name).alias("key"), (F.col("p_size") + (F.col("p_partkey") % 4) * 1024).cast("long").alias("value"))


@query("SELECT p_partkey AS k FROM part WHERE p_size % 4 = 0 AND p_size % 6 = 0")
def blank_windows(spark, sf):
    """Windows given and empty at both ends."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    end = lambda n: F.when(F.col("p_size") % n == 0, F.array().cast("array<double>")).otherwise(F.array(F.col("p_size").cast("double")))
    return ingest.blank_windows(p.select(F.col("p_partkey").alias("k"), end(4).alias("b"), end(6).alias("e"))).select("k")


@query("SELECT count(*) AS heaps, count(*) FILTER (WHERE event_id % 17 = 0) AS incomplete, count(*) FILTER (WHERE event_id % 17 <> 0 AND value < 5) AS too_old, count(*) FILTER (WHERE event_id % 17 <> 0 AND value >= 5) AS accepted FROM events")
def ingest_metrics(spark, sf):
    """Counters of an ingest: heaps, incomplete, too old, accepted."""
    return sens(spark, sf).agg(*ingest.counters(sens(spark, sf), F.col("event_id") % 17 != 0, F.col("value") < 5))


_BREAKS = """d AS (SELECT event_id, ant, ts, CASE key WHEN 'view' THEN 'slew' WHEN 'click' THEN 'track' WHEN 'purchase' THEN 'await_pipeline' ELSE key END AS activity FROM sens),
l AS (SELECT *, lag(activity) OVER w AS oa, lag(ts) OVER w AS ot FROM d WINDOW w AS (PARTITION BY ant ORDER BY ts, event_id))"""


@query(f"WITH {_BREAKS} SELECT event_id, ant FROM l WHERE activity = 'await_pipeline' AND ot <> ts AND NOT regexp_matches(oa, 'slew|stop|unknown|await_pipeline')")
def sync_barriers(spark, sf):
    """Dumps before which a batch breaks into waiting for the pipeline: there the pipeline synchronises."""
    activity = F.when(F.col("key") == "view", "slew").when(F.col("key") == "click", "track").when(F.col("key") == "purchase", "await_pipeline").otherwise(F.col("key"))
    d = sens(spark, sf).withColumns({"activity": activity, "activity_time": F.col("ts"), "tags": F.lit("gaincal")})
    brk = sensors.break_flag(["ant"], ["ts", "event_id"], "activity", "activity_time", "tags")
    return d.withColumn("brk", brk).where("brk = 1 AND activity = 'await_pipeline'").select("event_id", "ant")


@query("SELECT o.o_orderkey AS cb FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_orderkey IS NULL")
def empty_observations(spark, sf):
    """Capture blocks without data: they get no report."""
    blocks = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("cb"))
    return blocks.join(vis(spark, sf).select(F.col("dump").alias("cb")).distinct(), "cb", "left_anti")


# --- summaries and reports ------------------------------------------------------------------------


@query("""WITH b AS (SELECT chan, pol, ant1, ant2, sum(re * weight) FILTER (WHERE flags = 0) / sum(weight) FILTER (WHERE flags = 0) AS re, sum(weight) FILTER (WHERE flags = 0) AS w FROM vis GROUP BY ALL),
e AS (SELECT chan, pol, unnest([ant1, ant2]) AS ant, re, w FROM b WHERE w > 0) SELECT chan, pol, ant, round(sum(re * w) / sum(w), 6) AS re, round(sum(w), 6) AS weight FROM e GROUP BY ALL""")
def summary_full(spark, sf):
    """Average over time, then over the baselines of each antenna, weights kept."""
    out = average.summarize_full(vis(spark, sf), ["chan", "pol"])
    return out.select("chan", "pol", "ant", _r("re").alias("re"), _r("weight").alias("weight"))


@query("""SELECT chan, pol, ant1, ant2, round(avg(time), 3) AS time, round(sum(re * weight) FILTER (WHERE flags = 0) / sum(weight) FILTER (WHERE flags = 0), 6) AS re FROM vis WHERE (ant1 = 2) <> (ant2 = 2) GROUP BY ALL""")
def summary_refant(spark, sf):
    """Average over time of the reference antenna's baselines, stamped with the mean time; flagged ones are null."""
    return average.summarize(vis(spark, sf), ["chan", "pol"], 2, "time").select("chan", "pol", "ant1", "ant2", _r("time", 3).alias("time"), _r("re").alias("re"))


@query("SELECT chan, round(avg(sqrt(re * re + im * im)), 6) AS amp FROM vis WHERE chan % 2 = 0 GROUP BY chan")
def model_average(spark, sf):
    """Mean model amplitude over time, polarisation and baseline at every second channel."""
    return vis(spark, sf).where("chan % 2 = 0").groupBy("chan").agg(_r(F.avg(cplx.amplitude(cplx.col()))).alias("amp"))


@query("""WITH m AS (SELECT pol, ant1 AS ant, avg(sqrt(re * re + im * im)) AS ref FROM vis WHERE dump % 5 = 0 GROUP BY ALL), g AS (SELECT CAST(dump % 5 AS INTEGER) AS target, pol, ant1 AS ant, avg(sqrt(re * re + im * im)) AS amp FROM vis WHERE dump % 5 > 0 GROUP BY ALL)
SELECT target, round(quantile_cont(pow(amp / ref, 2), 0.5), 6) AS flux, round(stddev_samp(pow(amp / ref, 2)), 6) AS flux_std, count(*) AS n FROM g JOIN m ON g.pol = m.pol AND g.ant = m.ant GROUP BY target""")
def flux_against_model(spark, sf):
    """Flux of each target: its squared gain amplitudes over those on a modelled source, per antenna and polarisation."""
    amp = F.avg(cplx.amplitude(cplx.col()))
    rows = vis(spark, sf).withColumn("target", (F.col("dump") % 5).cast("int")).groupBy("target", "pol", F.col("ant1").alias("ant")).agg(amp.alias("amp"))
    model = rows.where("target = 0").select("pol", "ant", F.col("amp").alias("ref"))
    ratio = rows.where("target > 0").join(model, ["pol", "ant"]).withColumn("flux", F.pow(F.col("amp") / F.col("ref"), 2))
    return ratio.groupBy("target").agg(_r(robust.median(F.col("flux"))).alias("flux"), _r(F.stddev_samp("flux")).alias("flux_std"), F.count("*").alias("n"))


@query("""WITH n AS (SELECT ant, ts, row_number() OVER (PARTITION BY ant ORDER BY ts, event_id) AS k FROM sens WHERE key = 'signup'), c AS (SELECT ant, ts AS stop FROM n WHERE k = 3)
SELECT s.event_id FROM sens s LEFT JOIN c ON s.ant = c.ant WHERE c.stop IS NULL OR s.ts < c.stop""")
def limit_targets(spark, sf):
    """Entries before the third target (all where there are fewer)."""
    log = sens(spark, sf)
    return report.before_nth(log, log.where("key = 'signup'"), ["ant"], ["ts", "event_id"], 3, "ts").select("event_id")


@query("SELECT ant, dense_rank() OVER (ORDER BY ant) - 1 AS idx FROM (SELECT DISTINCT s_name AS ant FROM supplier)")
def antenna_index(spark, sf):
    """Index of the sorted antenna names (a small dimension)."""
    names = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_name").alias("ant")).distinct()
    return names.withColumn("idx", (F.dense_rank().over(Window.orderBy("ant")) - 1).cast("long"))


@query("""WITH t AS (SELECT ant, ts, event_id, row_number() OVER (PARTITION BY ant ORDER BY ts, event_id) AS k FROM sens WHERE key = 'view'), x AS (SELECT ant, event_id AS target, row_number() OVER (PARTITION BY ant ORDER BY ts, event_id) AS k FROM sens WHERE key = 'click')
SELECT t.event_id, x.target FROM t JOIN x ON t.ant = x.ant AND t.k = x.k""")
def times_of_targets(spark, sf):
    """Times and targets zipped by position."""
    log = sens(spark, sf)
    k = F.row_number().over(Window.partitionBy("ant").orderBy("ts", "event_id"))
    times, targets = log.where("key = 'view'").withColumn("k", k), log.where("key = 'click'").withColumn("k", k)
    return times.select("ant", "k", "event_id").join(targets.select("ant", "k", F.col("event_id").alias("target")), ["ant", "k"]).select("event_id", "target")


@query("""SELECT CAST(dump // 500 AS INTEGER) AS cb, min(time) AS first_time, count(DISTINCT dump) AS n_dumps, count(DISTINCT chan) AS n_chans,
 array_to_string(list_sort(list(DISTINCT CAST(ant1 AS VARCHAR))), ',') AS antennas FROM vis GROUP BY ALL""")
def observation_summary(spark, sf):
    """Start, counts and antennas of each capture block."""
    return report.summary(vis(spark, sf).withColumn("cb", F.floor(F.col("dump") / 500).cast("int")))


@query("""WITH s AS (SELECT l_orderkey AS k, l_linenumber AS d, min(CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'FINAL' END) AS v FROM lineitem GROUP BY ALL)
SELECT k, '{' || string_agg('"' || d || '":"' || v || '"', ',' ORDER BY d) || '}' AS states FROM s GROUP BY k""")
def dump_states(spark, sf):
    """State of each dump by name, as JSON with sorted keys."""
    name = F.when(F.col("l_linestatus") == "O", "OPEN").otherwise("FINAL")
    t = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("d"), name.alias("v"))
    return report.states_json(t.groupBy("k", "d").agg(F.min("v").alias("v")), ["k"], "d", "v")


@query("SELECT l_orderkey AS k, l_linenumber AS line, l_linenumber AS continuum_factor, l_tax * 20 AS rate_ratio FROM lineitem WHERE l_linenumber >= 1 AND l_tax * 20 > 1")
def validated_streams(spark, sf):
    """Settings parsed from JSON arrays; entries out of range (factor below 1, ratio of 1 or less) are left out."""
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = F.to_json(F.array(F.struct(F.col("l_linenumber").alias("continuum_factor"), (F.col("l_tax") * 20).alias("rate_ratio"))))
    parsed = F.from_json(text, "array<struct<continuum_factor:int,rate_ratio:double>>", {"mode": "FAILFAST"})
    rows = t.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.explode(parsed).alias("s")).select("k", "line", "s.*")
    return rows.where("continuum_factor >= 1 AND rate_ratio > 1")


@query("""WITH s AS (SELECT CAST(dump % 5 AS INTEGER) AS target, chan, pol, avg(re) AS re, avg(im) AS im, min(flags) AS flags FROM vis GROUP BY ALL), f(target, flux) AS (VALUES (1, 2.5), (3, 4.0))
SELECT s.target, chan, pol, round(CASE WHEN flags = 0 THEN sqrt(re * re + im * im) * coalesce(flux, 1) END, 6) AS amp, round(CASE WHEN flags = 0 THEN degrees(atan2(im, re)) END, 6) AS phase FROM s LEFT JOIN f ON s.target = f.target""")
def report_spectrum(spark, sf):
    """Amplitude and phase of each target's average, scaled by its measured flux; flagged ones hidden."""
    rows = vis(spark, sf).groupBy((F.col("dump") % 5).cast("int").alias("target"), "chan", "pol").agg(F.avg("re").alias("re"), F.avg("im").alias("im"), F.min("flags").alias("flags"))
    fluxes = spark.createDataFrame([(1, 2.5), (3, 4.0)], "target int, flux double")
    return report.spectrum(rows, fluxes).select("target", "chan", "pol", _r("amp").alias("amp"), _r("phase").alias("phase"))


@query("""WITH f AS (SELECT CAST(chan // 2 AS INTEGER) AS block, pol, ant1, ant2, count(*) FILTER (WHERE flags <> 0) AS nf, count(*) AS n FROM vis GROUP BY ALL)
SELECT block, pol, ant1, ant2, round(sqrt(pow(10.0 * (ant1 - ant2), 2) + pow(3.0 * (ant1 * ant1 - ant2 * ant2), 2)), 6) AS length, round(100.0 * nf / n, 6) AS flag_pct FROM f""")
def report_flags(spark, sf):
    """Flagged percentage per channel block and baseline, with the baseline's length to order by."""
    by_bl = vis(spark, sf).groupBy(F.floor(F.col("chan") / 2).cast("int").alias("block"), "pol", "ant1", "ant2").agg(F.count_if(F.col("flags") != 0).alias("n_flagged"), F.count("*").alias("n"))
    ants = spark.range(8).select(F.col("id").cast("int").alias("ant"), (F.col("id") * 10.0).alias("e"), (F.col("id") * F.col("id") * 3.0).alias("n"), F.lit(0.0).alias("u"))
    return report.flag_table(by_bl, ants).select("block", "pol", "ant1", "ant2", _r("length").alias("length"), _r("flag_pct").alias("flag_pct"))


@query("""WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'bfcal' WHEN 1 THEN 'gaincal polcal' WHEN 2 THEN 'target' ELSE 'bpcal target' END AS t FROM orders)
SELECT k, contains(t, 'bpcal') OR contains(t, 'bfcal') AS is_bp, contains(t, 'gaincal') AS is_gain, contains(t, 'polcal') AS is_pol, t = 'target' AS is_target FROM t""")
def report_groups(spark, sf):
    """The four overlapping groups of targets; a pure target is no calibrator."""
    kinds = F.element_at(F.array(*(F.split(F.lit(t), " ") for t in ("bfcal", "gaincal polcal", "target", "bpcal target"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), kinds.alias("tags"))
    return report.target_groups(o).select("k", "is_bp", "is_gain", "is_pol", "is_target")


@query("""SELECT s_suppkey AS cb, '{"antenna":"' || s_name || '","nation":"' || s_nationkey || '"}' AS json, s_name AS antenna, 'unknown' AS observer FROM supplier""")
def report_metadata(spark, sf):
    """One JSON text per capture block, keys in order; an absent attribute is unknown."""
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("cb"), F.create_map(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("antenna"), F.col("s_name")).alias("attributes"))
    named = s.select("cb", report.value_or_unknown(F.col("attributes"), "antenna").alias("antenna"), report.value_or_unknown(F.col("attributes"), "observer").alias("observer"))
    return report.metadata(s).join(named, "cb").select("cb", "json", "antenna", "observer")


@query("SELECT DISTINCT ant1, ant2, 'm' || CASE WHEN ant1 = 3 THEN ant2 ELSE ant1 END AS name FROM vis WHERE (ant1 = 3) <> (ant2 = 3)")
def report_refant(spark, sf):
    """Name of the other antenna of the reference antenna's baselines."""
    names = spark.range(8).select(F.col("id").cast("int").alias("ant"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("name"))
    return report.refant_labels(vis(spark, sf).select("ant1", "ant2").distinct(), names, 3)


@query("SELECT chan, pol, ant1 AS ant, round(sqrt(avg(re) * avg(re) + avg(im) * avg(im)), 6) AS amp, round(degrees(atan2(avg(im), avg(re))), 6) AS phase FROM vis GROUP BY ALL")
def report_amp_phase(spark, sf):
    """Amplitude and phase of solutions."""
    g = vis(spark, sf).groupBy("chan", "pol", F.col("ant1").alias("ant")).agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    return report.amp_phase(g).select("chan", "pol", "ant", _r("amp").alias("amp"), _r("phase").alias("phase"))


@query("SELECT CAST(o_custkey % 5 AS INTEGER) AS report, CASE WHEN bool_and(contains(o_orderpriority, 'LOW') OR o_totalprice > 1000) THEN 'Jy' ELSE 'arb' END AS units FROM orders GROUP BY ALL")
def report_units(spark, sf):
    """Jansky where every target of a report has a flux, else arbitrary."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_custkey") % 5).cast("int").alias("report"), F.when(F.contains("o_orderpriority", F.lit("LOW")) | (F.col("o_totalprice") > 1000), "Jy").otherwise("Counts").alias("units"))
    return report.common_units(o, ["report"])

"""The tag-driven reduction: which solution each scan sees, and targets that come out as one."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import apply, interp, rfi, solve
from lodestone.plans import reduction
from lodestone.sources import synthetic
from lodestone.streaming import batcher

CHANS, DUMPS = 32, 8


@pytest.fixture(scope="module")
def truth():
    return synthetic.Truth(n_ants=4, seed=1)


def _observation(spark, truth, tags, batch=None):
    """Scans of DUMPS dumps, 4 s each; every second scan with other gains is left to the caller."""
    v = synthetic.visibilities(spark, truth, CHANS, DUMPS * len(tags)).where("pol1 = pol2").withColumn("pol", F.col("pol1"))
    v = v.select("ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight")
    rows = [(k, (batch or [0] * len(tags))[k], f"t{k % 2}", t.split(), 100.0 + 4 * DUMPS * k, 100.0 + 4 * (DUMPS * (k + 1) - 1)) for k, t in enumerate(tags)]
    return v, spark.createDataFrame(rows, "scan int, batch int, target string, tags array<string>, t0 double, t1 double"), synthetic.channel_table(spark, CHANS, 856e6, 1284e6)


def test_separate_tags_give_two_gains_and_targets_come_out_as_one(spark, truth):
    """Newest first: the calibrator behind the target in time is solved before it."""
    v, scans, channels = _observation(spark, truth, ["target", "delaycal gaincal bpcal"])
    got = reduction.reduce_scans(v, scans, channels, 4, 0)
    assert got["G"].select("solint").distinct().count() == 2 and got["G"].select("scan").distinct().collect() == [(1,)]
    flat = got["corrected"].where("ant1 <> ant2").groupBy("scan").agg(F.max(F.abs(F.col("re") - 1)).alias("re"), F.max(F.abs("im")).alias("im"), F.count("re").alias("n")).collect()
    assert len(flat) == 2 and all(r.re < 1e-2 and r.im < 1e-2 and r.n == 2 * 6 * CHANS * DUMPS for r in flat)
    k = got["K"].where("pol = 'h'").orderBy("ant").toPandas().delay.to_numpy()
    assert np.allclose(k, truth.delay[1] - truth.delay[1, 0], rtol=1e-3, atol=1e-15)
    b = got["B"].groupBy("pol", "ant").agg(F.avg("re").alias("re"), F.avg("im").alias("im")).collect()
    assert all(abs(r.re - 1) < 1e-9 and abs(r.im) < 1e-9 for r in b)


def test_a_scan_before_any_solution_stays_as_it_is(spark, truth):
    v, scans, channels = _observation(spark, truth, ["target", "bfcal"], batch=[0, 1])
    got = reduction.reduce_scans(v, scans, channels, 4, 0)
    raw = v.where(f"dump < {DUMPS}").select("dump", "chan", "pol", "ant1", "ant2", "re", "im")
    same = got["corrected"].where("scan = 0").select("dump", "chan", "pol", "ant1", "ant2", "re", "im")
    assert same.exceptAll(raw).count() == 0 and same.count() == raw.count()
    assert got["G"].select("solint").distinct().count() == 1


def test_gains_of_the_own_target_come_first_and_times_are_interpolated(spark):
    scans = spark.createDataFrame([(0, 0, "a", ["gaincal"], 0.0, 10.0), (1, 0, "b", ["gaincal"], 20.0, 30.0), (2, 1, "b", ["target"], 40.0, 50.0), (3, 1, "c", ["target"], 10.0, 20.0), (4, 2, "c", ["target"], 9000.0, 9010.0)], "scan int, batch int, target string, tags array<string>, t0 double, t1 double")
    scans = reduction.processing_order(scans)
    assert [r.scan for r in scans.orderBy("proc_seq").collect()] == [1, 0, 3, 2, 4]
    gains = spark.createDataFrame([(0, 5.0, "h", 0, 1.0, 0.0), (1, 25.0, "h", 0, 3.0, 0.0)], "scan int, time double, pol string, ant int, re double, im double")
    dumps = spark.createDataFrame([(2, 8, 45.0), (3, 3, 15.0), (4, 90, 9000.0), (0, 1, 5.0), (1, 5, 25.0)], "scan int, dump int, ts double")
    got = {r.scan: r.re for r in reduction.gains_at_dumps(dumps, scans, gains).collect()}
    # Scan 2: its own target's; 3: half way between both; 4: none within two hours; 0: its own target's, 1: solved before 0.
    assert got == {2: 3.0, 3: 2.0, 0: 1.0, 1: 3.0}


def test_outliers_of_a_bandpass_are_cut(spark):
    rng = np.random.default_rng(3)
    rows = [(0, "h", 0, c, 1.5 if c == 40 else float(1 + 0.01 * rng.normal()), 0.0) for c in range(128)]
    got = rfi.flag_spectra(spark.createDataFrame(rows, "scan int, pol string, ant int, chan int, re double, im double"), ["scan", "pol", "ant"]).toPandas()
    assert got[got.chan == 40].re.isna().all() and got.re.isna().sum() < 32


def _drifting(v, turns):
    """Every antenna's phase turns with time, by its number times ``turns`` over the dumps of a scan."""
    angle = 2 * np.pi * turns * (F.col("ant1") - F.col("ant2")) * (F.col("dump") % DUMPS) / DUMPS
    c, s = F.cos(angle), F.sin(angle)
    return v.withColumn("_re", F.col("re") * c - F.col("im") * s).withColumn("im", F.col("re") * s + F.col("im") * c).withColumn("re", F.col("_re")).drop("_re")


def test_a_drifting_calibrator_gives_the_same_delays_and_bandpass(spark, truth):
    """Antenna 3 turns once in the scan, so its average over time is nothing; preliminary gains take that off."""
    v, scans, channels = _observation(spark, truth, ["delaycal bpcal gaincal"])
    settings = reduction.Settings(k_solint=1, bp_solint=1, g_solint=1, k_window=(4, 28), g_window=(8, 24))
    got, want = (reduction.reduce_scans(x, scans, channels, 4, 0, settings) for x in (_drifting(v, 1 / 3), v))
    for name, tolerance in (("K", 1e-3 * 1e-9), ("B", 1e-2)):
        keys = ["pol", "ant"] + ["chan"] * (name == "B")
        a, b = (x[name].orderBy(*keys).toPandas() for x in (got, want))
        for c in ("delay",) if name == "K" else ("re", "im"):
            assert np.allclose(a[c], b[c], atol=tolerance) and a[c].notna().all()
    k = got["K"].where("pol = 'h'").orderBy("ant").toPandas().delay.to_numpy()
    assert np.allclose(k, truth.delay[1] - truth.delay[1, 0], rtol=1e-3, atol=1e-15)
    assert got["G"].select("solint").distinct().count() == DUMPS
    flat = got["corrected"].where("ant1 <> ant2").agg(F.max(F.abs(F.col("re") - 1)).alias("re"), F.max(F.abs("im")).alias("im")).first()
    assert flat.re < 2e-2 and flat.im < 2e-2
    b = got["B"].where("chan >= 8 AND chan < 24").groupBy("pol", "ant").agg(F.avg("re").alias("re"), F.avg("im").alias("im")).collect()
    assert all(abs(r.re - 1) < 1e-9 and abs(r.im) < 1e-9 for r in b)


def test_gains_half_a_turn_apart_keep_their_amplitude(spark):
    scans = reduction.processing_order(spark.createDataFrame([(0, 0, "a", ["gaincal"], 0.0, 30.0)], "scan int, batch int, target string, tags array<string>, t0 double, t1 double"))
    gains = spark.createDataFrame([(0, 0.0, "h", 0, 2.0, 0.0), (0, 20.0, "h", 0, -2.0, 1e-9)], "scan int, time double, pol string, ant int, re double, im double")
    dumps = spark.createDataFrame([(0, 1, 10.0)], "scan int, dump int, ts double")
    r = reduction.gains_at_dumps(dumps, scans, gains).first()
    assert abs(r.re) < 1e-6 and abs(r.im - 2) < 1e-6


def test_capture_blocks_do_not_see_each_other(spark, truth):
    """Two blocks at the same times in one table: the second has no calibrator, so its target stays as it is."""
    v, scans, channels = _observation(spark, truth, ["delaycal gaincal bpcal", "target"])
    both = v.withColumn("cb", F.lit("one")).unionByName(v.where(f"dump >= {DUMPS}").withColumn("cb", F.lit("two")))
    scans = scans.withColumn("cb", F.lit("one")).unionByName(scans.where("scan = 1").withColumn("cb", F.lit("two")).withColumn("scan", F.lit(9)))
    got = reduction.reduce_scans(both, scans.withColumn("batch", F.col("scan")), channels, 4, 0)["corrected"]
    raw = v.where(f"dump >= {DUMPS}").select("dump", "chan", "pol", "ant1", "ant2", "re", "im")
    same = got.where("scan = 9").select(*raw.columns)
    assert same.exceptAll(raw).count() == 0 and same.count() == raw.count()
    flat = got.where("scan = 1 AND ant1 <> ant2").agg(F.max(F.abs(F.col("re") - 1)).alias("re"), F.count("re").alias("n")).first()
    assert flat.re < 1e-2 and flat.n == 2 * 6 * CHANS * DUMPS


def test_two_sources_by_their_model_and_four_hands(spark, truth):
    """A calibrator of two sources: divided by its model it gives the gains of a point, and all hands are corrected."""
    v = synthetic.visibilities(spark, truth, CHANS, DUMPS).withColumn("pol", F.concat("pol1", "pol2"))
    v = v.select("ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight")
    turn = 0.3 * (F.col("ant1") - F.col("ant2")) * (1 + F.col("chan") / 10) + 0.2 * F.col("dump")
    m_re, m_im = 1 + 0.4 * F.cos(turn), 0.4 * F.sin(turn)
    model = v.select("dump", "chan", "ant1", "ant2").distinct().withColumn("re", m_re).withColumn("im", m_im)
    seen = v.withColumn("_r", F.col("re") * m_re - F.col("im") * m_im).withColumn("im", F.col("re") * m_im + F.col("im") * m_re).withColumn("re", F.col("_r")).drop("_r")
    scans = spark.createDataFrame([(0, 0, "t", ["delaycal", "bpcal", "gaincal"], 100.0, 100.0 + 4 * DUMPS)], "scan int, batch int, target string, tags array<string>, t0 double, t1 double")
    channels = synthetic.channel_table(spark, CHANS, 856e6, 1284e6)
    with_model, point = (reduction.reduce_scans(x, scans, channels, 4, 0, model=m) for x, m in ((seen, model), (v, None)))
    for name, cols in (("K", ["delay"]), ("B", ["re", "im"]), ("G", ["re", "im"])):
        keys = [c for c in ("scan", "solint", "chan", "pol", "ant") if c in point[name].columns]
        a, b = (x[name].orderBy(*keys).toPandas() for x in (with_model, point))
        assert all(np.allclose(a[c], b[c], rtol=5e-2, atol=1e-12 if name == "K" else 5e-3) for c in cols)
    flat = apply.divide_model(with_model["corrected"].where("ant1 <> ant2"), model, ["dump", "chan", "ant1", "ant2"])
    parallel = flat.where("pol IN ('hh', 'vv')").agg(F.max(F.abs(F.col("re") - 1)).alias("re"), F.max(F.abs("im")).alias("im")).first()
    assert parallel.re < 5e-2 and parallel.im < 5e-2
    cross = point["corrected"].where("ant1 <> ant2 AND pol IN ('hv', 'vh')")
    want = flat.where("pol IN ('hv', 'vh')").select("dump", "chan", "pol", "ant1", "ant2", F.col("re").alias("wr"), F.col("im").alias("wi"))
    apart = cross.join(want, ["dump", "chan", "pol", "ant1", "ant2"]).agg(F.max(F.hypot(F.col("re") - F.col("wr"), F.col("im") - F.col("wi"))).alias("d"), F.count("re").alias("n")).first()
    assert apart.d < 5e-2 and apart.n == 2 * 6 * CHANS * DUMPS


def test_flaggers_of_calibrators_and_targets(spark, truth):
    """Bursts in a calibrator and a target: each is found by its own flagger, and the calibrator's doesn't spoil the gains."""
    v, scans, channels = _observation(spark, truth, ["delaycal gaincal bpcal", "target"], batch=[0, 1])
    burst = (F.col("dump") % DUMPS == 5) & (F.col("chan") % 3 == 0)
    noisy = v.withColumn("re", F.col("re") * (1 + 0.002 * F.randn(3)) + F.when(burst, 500.0).otherwise(0.0))
    calib, targ = rfi.Flagger(chunk_dumps=DUMPS, spike_time=2.0, spike_freq=0.0), rfi.Flagger(nsigma=1e9)
    got = reduction.reduce_scans(noisy, scans, channels, 4, 0, reduction.Settings(flaggers=(calib, targ)))["corrected"]
    hit = got.withColumn("burst", burst).where("ant1 <> ant2").groupBy("scan", "burst").agg(F.avg((F.col("flags") != 0).cast("double")).alias("share"), F.max(F.when(F.col("flags") == 0, F.abs(F.col("re") - 1))).alias("off")).collect()
    by = {(r.scan, r.burst): r for r in hit}
    assert by[0, True].share == 1.0 and by[0, False].share < 0.05 and by[1, True].share == by[1, False].share == 0.0
    assert by[0, False].off < 5e-2 and by[1, False].off < 5e-2


PLANE = "scan int, pol string, ant1 int, ant2 int, dump int, chan int, re double, im double, flags int, weight double"
KEYS = ("scan", "pol", "ant1", "ant2")


def test_flags_do_not_depend_on_tiles(spark):
    """The whole flag table is the same for 1, 2, 8 and more tiles, with a burst and a band at their borders."""
    rng = np.random.default_rng(4)
    amp = 1 + 0.02 * rng.normal(size=(300, 96))
    amp[126:130, 20:60] += 0.3
    amp[:, 47:49] += 0.06
    rows = [(0, "h", 0, 1, d, c, float(amp[d, c]), 0.0, int(d % 37 == 5), 1.0) for d in range(300) for c in range(96) if (d * 7 + c) % 41]
    df = spark.createDataFrame(rows, PLANE)
    f = rfi.Flagger(chunk_dumps=16, chunk_chans=16, spike_time=3.0, spike_freq=2.0, average=2, extend=3, windows_freq=(1, 2, 4, 8))
    tables = [sorted(map(tuple, rfi.flag_interference(df, KEYS, f, dumps=d, block=b).collect())) for d, b in ((1000, 1000), (160, 1000), (64, 48), (16, 16))]
    assert all(t == tables[0] for t in tables[1:])
    hit = {(r[4], r[5]) for r in tables[0] if r[8] & rfi.CAL_RFI}
    burst = {(d, c) for d in range(126, 130) for c in range(20, 60) if d % 37 != 5 and (d * 7 + c) % 41}
    assert len(hit & burst) > 0.8 * len(burst) and all(r[8] & 1 == (r[4] % 37 == 5) for r in tables[0])
    again = rfi.flag_interference(spark.createDataFrame(tables[0], PLANE), KEYS, f)
    assert sorted(map(tuple, again.collect())) == tables[0]


def test_spikes_beside_a_ripple_are_found():
    """A ripple of 56 channels, ten times the noise: all spikes of 20 sigma are found, and little else."""
    rng = np.random.default_rng(7)
    t, c = np.mgrid[:256, :512]
    amp = 5 + 0.1 * np.sin(2 * np.pi * c / 56) + 0.01 * rng.normal(size=t.shape)
    spikes = rng.random(t.shape) < 0.004
    new = rfi.sum_threshold(amp + 0.2 * spikes, np.zeros(t.shape, bool), rfi.Flagger(spike_freq=3.0))
    assert new[spikes].all() and (new & ~spikes).sum() < 0.01 * spikes.size
    none = rfi.sum_threshold(amp, np.zeros(t.shape, bool), rfi.Flagger(spike_freq=3.0))
    assert none.mean() < 0.005


def test_a_channel_with_few_cells_in_a_chunk_is_not_its_bandpass(spark):
    """Cells far from others of their channel are measured by the chunks beside; a burst among them is found, for any tiles."""
    rng = np.random.default_rng(5)
    amp = 2 + 0.1 * np.arange(8) + 0.005 * rng.uniform(-1, 1, size=(320, 8))
    bad = np.zeros(amp.shape, bool)
    bad[128:192, 7] = True
    bad[[158, 160, 162], 7] = False
    amp[160] += 3
    burst = np.zeros(amp.shape, bool)
    burst[160] = True
    f = rfi.Flagger(spike_freq=0.0)
    assert (rfi.sum_threshold(amp, bad, f) == burst).all()
    rows = [(0, "h", 0, 1, d, c, float(amp[d, c]), 0.0, int(bad[d, c]), 1.0) for d in range(320) for c in range(8)]
    for dumps in (64, 320):
        got = rfi.flag_interference(spark.createDataFrame(rows, PLANE), KEYS, f, dumps=dumps).where(f"flags & {rfi.CAL_RFI} <> 0").select("dump", "chan").collect()
        assert sorted(map(tuple, got)) == [(160, c) for c in range(8)]


def test_flagger_of_parameters():
    p = {"rfi_calib_nsigma": 4.5, "rfi_targ_nsigma": 7.0, "rfi_windows_freq": [1, 8, 16, 32], "rfi_average_freq": 4, "rfi_calib_spike_width_freq": 80, "rfi_targ_spike_width_freq": 160, "rfi_spike_width_time": 100.0, "rfi_extend_freq": 15, "rfi_freq_chunks": 2}
    calib, targ = (rfi.Flagger.of_parameters(p, 4.0, 1022, kind) for kind in ("calib", "targ"))
    assert (calib.nsigma, targ.nsigma, calib.spike_time, calib.spike_freq, targ.spike_freq) == (4.5, 7.0, 25.0, 80, 160)
    assert calib.chunk_chans == 512 and calib._windows(1) == [1, 2, 4, 8] and all(h % n == 0 for h, n in zip(calib.halo, (64, 512), strict=True))
    amp = 1 + 0.01 * np.random.default_rng(1).normal(size=(64, 1022))
    amp[30, 400:404] += 1
    new = calib.plane(amp, np.zeros(amp.shape, bool))
    # Four averaged channels and seven more on each side.
    assert new[30, 393:411].all() and not new[30, 380:390].any() and not new[10:20].any()


def test_last_batches_are_emitted_and_state_goes(spark, tmp_path):
    rows = [("cb", g, d, "track", 0.0, "gaincal", False, 0, f"p{g}{d}") for g in (0, 1) for d in (0, 1, 3, 4)] + [("cb", g, None, None, None, None, True, None, None) for g in (0, 1)]
    spark.createDataFrame([(*r, None, None) for r in rows], batcher.HEAP).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batcher.HEAP).parquet(str(tmp_path / "in"))
    batcher.write_batches(batcher.batch_stream(stream, 3), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = sorted((r.chan_group, r.batch, r.dump, r.flags, r.payload) for r in spark.read.schema(batcher.OUT).parquet(str(tmp_path / "out")).collect())
    lost = batcher.DATA_LOST
    assert got == [x for g in (0, 1) for x in [(g, 0, 0, 0, f"p{g}0"), (g, 0, 1, 0, f"p{g}1"), (g, 0, 2, lost, None), (g, 1, 3, 0, f"p{g}3"), (g, 1, 4, 0, f"p{g}4")]]


def test_a_long_key_is_interpolated_in_one_pass(spark):
    """60,000 dumps of one key: a window that is read anew for every row takes minutes."""
    solutions = spark.createDataFrame([("a", 0.0, 1.0, 0.0), ("a", 30000.0, 2.0, 0.0), ("a", 60000.0, 4.0, 0.0)], "k string, ts double, re double, im double")
    times = spark.range(60001).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("ts"))
    start = time.time()
    got = {r.ts: r.re for r in interp.complex_at_times(solutions, times, ["k"], "ts").collect()}
    assert time.time() - start < 30
    # A time at which there is a solution takes it as it is.
    assert len(got) == 60001 and got[0.0] == 1 and got[30000.0] == 2 and got[60000.0] == 4 and np.isclose(got[45000.0], 3) and np.isclose(got[15000.0], 1.5)


def test_gains_and_spectra_of_many_keys_are_those_of_each_alone(spark):
    rng = np.random.default_rng(8)
    a1, a2 = np.triu_indices(4, 1)
    rows, want = [], {}
    for key in range(30):
        g = rng.uniform(0.5, 2, (4, 3)) * np.exp(1j * rng.uniform(-1, 1, (4, 3)))
        g = g * (np.abs(g[0]) / g[0])
        want |= {(key, c, a): g[a, c] for a in range(4) for c in range(3)}
        for a, b, c in ((a, b, c) for a, b in zip(a1, a2, strict=True) for c in range(3)):
            v = g[a, c] * np.conj(g[b, c])
            turned = rng.random() < 0.5  # a baseline may come the other way round
            a, b, v = (b, a, np.conj(v)) if turned else (a, b, v)
            rows.append((key, c, "h", int(a), int(b), float(v.real), float(v.imag), 0, float(rng.uniform(1, 9))))
        rows.append((key, 0, "h", 0, 1, 1e6, 0.0, 1, 1.0) if key % 2 else (key, 0, "h", 1, 0, None, None, 0, 1.0))
    vis = spark.createDataFrame(rows, "scan int, chan int, pol string, ant1 int, ant2 int, re double, im double, flags int, weight double").coalesce(1)
    got = solve.solve_gains(vis, ["scan"], 4, 0).collect()
    assert len(got) == len(want) and all(abs(complex(r.re, r.im) - want[r.scan, r.chan, r.ant]) < 1e-6 and r.snr > 1e5 for r in got)
    spectra, sizes = [], {}
    for key in range(40):
        amp = 1 + 0.01 * rng.normal(size=16 + key % 3)
        amp[5] += key % 4
        sizes[key] = amp
        spectra += [(key, c, float(x), 0.0) for c, x in enumerate(amp)]
    f = rfi.Flagger()
    flagged = {(r.k, r.chan) for r in rfi.flag_spectra(spark.createDataFrame(spectra, "k int, chan int, re double, im double").coalesce(1), ["k"], f).where("re IS NULL").collect()}
    alone = {(k, int(c)) for k, amp in sizes.items() for c in np.flatnonzero(f.plane(amp[None], np.zeros((1, len(amp)), bool))[0])}
    assert flagged == alone and {(k, 5) for k in sizes if k % 4} <= flagged


def _gain_rows(rng, scans, at, n_ants, name, kind):
    """Gains at each of ``at``: some missing, null, NaN or zero."""
    odd = {0: (None, None), 1: (float("nan"), 0.0), 2: (0.0, 0.0)}
    rows = [(s, x, p, a, *odd.get(int(rng.integers(0, 25)), (float(rng.normal()), float(rng.normal())))) for s in scans for x in at for p in "hv" for a in range(n_ants) if rng.random() > 0.05]
    return rows, f"scan bigint, {name} {kind}, pol string, ant int, re double, im double"


@pytest.mark.parametrize("tiles", [1, 3])
@pytest.mark.parametrize("weights", [False, True])
def test_scans_are_divided_as_by_joins(spark, tiles, weights):
    """Rows and gains that meet once, by scan, give what joins by channel and by interpolated dump give; scan 3 has no bandpass, scan 4 no gains, scan 5 neither."""
    rng = np.random.default_rng(tiles)
    pols = ("h", "v", "hv", "vh")
    cells = [
        (s, 100.0 + 4 * d, d, c, pols[int(rng.integers(0, 4))], a, b, None if rng.random() < 0.05 else float(rng.normal()), float(rng.normal()), int(rng.random() < 0.2), float(rng.integers(1, 9)))
        for s in range(1, 6) for d in range(9) for c in range(5) for a in range(4) for b in range(a, 4) if rng.random() < 0.7
    ]
    rows = spark.createDataFrame(cells, "scan int, ts double, dump bigint, chan int, pol string, ant1 int, ant2 int, re double, im double, flags int, weight double")
    # Antenna 3 and channel 4 have no gains.
    band = spark.createDataFrame(*_gain_rows(rng, (1, 2, 4), range(4), 3, "chan", "int"))
    knots = spark.createDataFrame(*_gain_rows(rng, (1, 2, 3), (99.0, 108.0, 111.0, 125.5), 3, "ts", "double"))
    times = rows.select("scan", "dump", "ts").distinct().join(knots.select("scan", "pol", "ant").distinct(), "scan")
    at = interp.complex_at_times(knots, times, ["scan", "pol", "ant"], "ts").select("scan", "dump", "pol", "ant", "re", "im")
    for b, k in ((band, knots), (band, None), (None, knots)):
        want = rows if b is None else reduction._applied(rows, b, ["scan", "chan"], weights)
        want = want if k is None else reduction._applied(want, at, ["scan", "dump"], weights)
        got = apply.divide_scans(rows, b, k, weights, tiles)
        assert [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
        key = ["scan", "dump", "chan", "pol", "ant1", "ant2"]
        one, two = (d.toPandas().sort_values(key).reset_index(drop=True) for d in (got, want))
        assert (one[[*key, "ts", "flags"]] == two[[*key, "ts", "flags"]]).all().all() and len(one) == len(cells)
        for c in ("re", "im", "weight"):
            x, y = one[c].to_numpy(dtype=float), two[c].to_numpy(dtype=float)
            assert (np.isnan(x) == np.isnan(y)).all() and np.allclose(x, y, rtol=1e-9, atol=1e-12, equal_nan=True)
        assert got.where("isnan(re) OR isnan(weight)").isEmpty()


def test_rows_of_scans_are_shuffled_once(spark, truth):
    """A scan that fits a task stays together: the corrected rows come from a scan of buckets, and only gains are shuffled to them."""
    v, scans, channels = _observation(spark, truth, ["target", "delaycal gaincal bpcal"])
    plan = reduction.reduce_scans(v, scans, channels, 4, 0)["corrected"]._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Bucketed: true" in plan and "Window" not in plan and "SortMergeJoin" not in plan


def test_a_long_scan_is_dealt_by_its_channels(spark, truth, monkeypatch):
    """Tiles of channels give the solutions and the rows of whole scans."""
    v, scans, channels = _observation(spark, truth, ["target", "delaycal gaincal bpcal"])
    settings = reduction.Settings(k_solint=1, bp_solint=1, g_solint=1)
    whole = reduction.reduce_scans(v, scans, channels, 4, 0, settings)
    monkeypatch.setattr(reduction, "ROWS", 500)
    tiled = reduction.reduce_scans(v, scans, channels, 4, 0, settings)
    for name, keys in (("K", ["scan", "pol", "ant"]), ("B", ["scan", "pol", "ant", "chan"]), ("G", ["scan", "solint", "pol", "ant"]), ("corrected", ["scan", "dump", "chan", "pol", "ant1", "ant2"])):
        one, two = (x[name].toPandas().sort_values(keys).reset_index(drop=True) for x in (whole, tiled))
        assert len(one) == len(two) > 0
        for c in ("delay",) if name == "K" else ("re", "im"):
            assert np.allclose(one[c].to_numpy(dtype=float), two[c].to_numpy(dtype=float), rtol=1e-6, atol=1e-12, equal_nan=True)

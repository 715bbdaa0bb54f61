"""Recovery: corrupt with known gains and delays, solve, compare."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import apply, average, model, pointing, rfi, solve
from lodestone.plans import pipeline
from lodestone.sources import synthetic


@pytest.fixture(scope="module")
def truth():
    return synthetic.Truth(n_ants=4, seed=1)


@pytest.fixture(scope="module")
def data(spark, truth):
    v = synthetic.visibilities(spark, truth, n_chans=64, n_dumps=3).withColumn("scan", F.lit(0)).cache()
    return v, synthetic.channel_table(spark, 64, 856e6, 1284e6)


@pytest.fixture(scope="module")
def products(data):
    v, channels = data
    return {k: p.cache() for k, p in pipeline.calibrate(v, channels, 4, 0).items()}


def test_delays_within_one_in_a_thousand(products, truth):
    k = products["K"].toPandas()
    for p, pol in enumerate(synthetic.POLS):
        got = k[k.pol == pol].sort_values("ant").delay.to_numpy()
        want = truth.delay[p] - truth.delay[p, 0]
        assert np.allclose(got, want, rtol=1e-3, atol=1e-15)


def test_bandpass_times_gain_within_one_percent(products, truth):
    b = products["B"].toPandas()
    g = products["G"].toPandas().set_index(["pol", "ant"])
    for p, pol in enumerate(synthetic.POLS):
        turn = truth.gain[p, 0] / abs(truth.gain[p, 0])
        for a in range(4):
            mine = b[(b.pol == pol) & (b.ant == a)]
            total = (mine.re + 1j * mine.im).to_numpy() * complex(g.loc[(pol, a)].re, g.loc[(pol, a)].im)
            assert np.allclose(total, truth.gain[p, a] / turn, rtol=1e-2)


def test_apply_undoes_the_corruption(data, products):
    v, channels = data
    flat = pipeline.apply_all(v.where("pol1 = pol2 and ant1 <> ant2"), products, channels)
    worst = flat.agg(F.max(F.abs(F.col("re") - 1)).alias("re"), F.max(F.abs("im")).alias("im")).first()
    assert worst.re < 1e-2 and worst.im < 1e-2


def test_weights_follow_pre_apply_only(spark, data, products):
    v, _ = data
    hands = pipeline.parallel_hands(v)
    g = products["G"].select("pol", "ant", F.lit(2.0).alias("re"), F.lit(0.0).alias("im"))
    kept = apply.apply_gains(hands, g).agg(F.max("weight")).first()[0]
    grown = apply.apply_gains(hands, g, (), True).agg(F.max("weight"), F.min("weight")).first()
    assert kept == 1.0 and grown[0] == grown[1] == 16.0


def test_missing_and_nan_gains_give_null_and_no_weight(spark):
    vis = spark.createDataFrame([(0, 1, "h", 1.0, 0.0, 0, 1.0)], "ant1 int, ant2 int, pol string, re double, im double, flags int, weight double")
    gains = spark.createDataFrame([(0, "h", float("nan"), 0.0), (1, "h", 1.0, 0.0)], "ant int, pol string, re double, im double")
    r = apply.apply_gains(vis, gains, (), True).first()
    assert r.re is None and r.im is None and r.weight == 0.0


def test_stefcal_is_permutation_invariant():
    rng = np.random.default_rng(3)
    g = rng.normal(2, 0.3, 5) + 1j * rng.normal(0, 0.3, 5)
    a1, a2 = np.triu_indices(5, 1)
    vis = g[a1] * g[a2].conj()
    got = solve.stefcal(vis, np.ones(len(vis)), a1, a2, 5, 0)
    p = rng.permutation(len(vis))
    again = solve.stefcal(vis[p], np.ones(len(vis)), a1[p], a2[p], 5, 0)
    want = g * np.abs(g[0]) / g[0]
    assert np.allclose(got, want, rtol=1e-6) and np.allclose(again, got)


def test_stefcal_all_flagged_is_nan():
    a1, a2 = np.triu_indices(4, 1)
    assert np.isnan(solve.stefcal(np.full(6, np.nan, complex), np.ones(6), a1, a2, 4, 0)).all()


def test_cross_delay_and_phase(spark):
    channels = synthetic.channel_table(spark, 64, 856e6, 1284e6)
    rows = channels.withColumns({"ant": F.lit(0), "weight": F.lit(1.0), "re": F.cos(2 * np.pi * 3e-11 * F.col("freq_hz")), "im": F.sin(2 * np.pi * 3e-11 * F.col("freq_hz"))}).drop("freq_hz")
    got = solve.solve_cross_delay(rows, channels, ["ant"], "h").first()
    assert np.isclose(got.delay, 3e-11, rtol=1e-3)
    unit = solve.cross_phase(rows.withColumn("re", F.col("re") * 5).withColumn("im", F.col("im") * 5)).first()
    assert np.isclose(unit.re**2 + unit.im**2, 1.0)


def test_spline_of_a_straight_line():
    knots = np.array([0, 0, 0, 0, 1, 1, 1, 1], dtype=float)
    got = solve.spline(np.array([0.0, 0.25, 0.5, 1.0]), knots, np.array([0, 1 / 3, 2 / 3, 1.0]), 3)
    assert np.allclose(got, [0, 0.25, 0.5, 1.0])


def test_reference_antenna_avoids_noise_and_flags(spark, truth):
    v = synthetic.visibilities(spark, truth, 16, 4)
    noisy = v.withColumn("im", F.col("im") + F.when((F.col("ant1") == 0) | (F.col("ant2") == 0), F.randn(5) * 30).otherwise(0.0))
    hands = pipeline.parallel_hands(noisy)
    first = solve.reference_antenna(hands).first().ant
    assert first != 0
    assert solve.reference_antenna(hands, previous=first).first().ant == first
    flagged = hands.withColumn("flags", F.when((F.col("ant1") == first) | (F.col("ant2") == first), 1).otherwise(F.col("flags")))
    assert solve.reference_antenna(flagged, previous=first).first().ant not in (0, first)


def test_ranking_likes_delays_and_leaves_noise_last(spark, truth):
    """Antenna 1 has a delay of twice one over the bandwidth, antenna 3 is noise, antenna 2 is flagged for the most part."""
    v = pipeline.parallel_hands(synthetic.visibilities(spark, truth, 64, 4))
    channels = synthetic.channel_table(spark, 64, 856e6, 1284e6)
    number = lambda a: (F.col("ant1") == a).cast("int") - (F.col("ant2") == a).cast("int")
    angle = 2 * np.pi * 2 * F.col("chan") / 64 * number(1)
    turned = v.withColumn("_r", F.col("re") * F.cos(angle) - F.col("im") * F.sin(angle)).withColumn("im", F.col("re") * F.sin(angle) + F.col("im") * F.cos(angle)).withColumn("re", F.col("_r")).drop("_r")
    noise = number(3) != 0
    seen = turned.withColumn("re", F.when(noise, F.randn(1)).otherwise(F.col("re"))).withColumn("im", F.when(noise, F.randn(2)).otherwise(F.col("im")))
    places = lambda **kw: [r.ant for r in solve.antenna_ranking(seen, channels, **kw).orderBy("place").collect()]
    first = places()
    assert first[-1] == 3 and set(first[:3]) == {0, 1, 2}
    quality = {r.ant: r.quality for r in solve.antenna_ranking(seen, channels).collect()}
    assert quality[1] > 0.8 * quality[first[0]] and quality[3] < 0.5 * quality[1]
    assert places(previous=3)[0] == 3
    seen = seen.withColumn("flags", F.when(number(2) != 0, 1).otherwise(F.col("flags")))
    assert places(most_flagged=0.9, previous=2)[-1] == 2


def test_interference_is_found_and_idempotent(spark, truth):
    v = synthetic.visibilities(spark, truth, 64, 12, corrupt=(4, 9), noise=0.05)
    v = v.withColumn("im", F.col("im") + F.when(F.col("chan") == 20, 50.0).otherwise(0.0))
    once = pipeline.flag(v).cache()
    hit = once.where("ant1 <> ant2").groupBy("dump", "chan").agg(F.min("flags").alias("f")).toPandas()
    bad = hit[hit.dump.isin([4, 9]) | (hit.chan == 20)]
    assert (bad.f > 0).mean() > 0.95
    assert (hit[~(hit.dump.isin([4, 9]) | (hit.chan == 20))].f > 0).mean() < 0.05
    twice = pipeline.flag(once)
    key = ["dump", "chan", "ant1", "ant2", "pol", "flags"]
    assert once.select(key).exceptAll(twice.select(key)).count() == 0


def test_average_edge_cases(spark):
    rows = [("a", 1.0, 0.0, 0, 2.0), ("a", 3.0, 0.0, 0, 2.0), ("a", 99.0, 0.0, 1, 2.0), ("b", 1.0, 0.0, 1, 1.0), ("c", float("nan"), 0.0, 1, 1.0), ("c", 5.0, 0.0, 0, 1.0)]
    df = spark.createDataFrame(rows, "k string, re double, im double, flags int, weight double")
    got = {r.k: r for r in average.wavg(df, ["k"]).collect()}
    assert got["a"].re == 2.0 and got["a"].weight == 4.0 and got["a"].flags == 0
    assert got["b"].re is None and got["b"].flags == 1 and got["b"].weight == 0.0
    assert got["c"].re == 5.0
    assert average.wavg(df.limit(0), ["k"]).count() == 0


def test_model_of_offset_sources(spark):
    line = "src, radec, 0:0:0, 0:0:36, 800 2000 wsclean 2.0 [] false 1284e6"
    c = model.parse_component(line)
    comps = spark.createDataFrame([("m", 0, *c)], model.COMPONENT)
    channels = synthetic.channel_table(spark, 4, 856e6, 1284e6)
    bl = spark.createDataFrame([(0, 0, 1, 0.0, 100.0, 0.0)], "dump int, ant1 int, ant2 int, u double, v double, w double")
    got = model.model_visibilities(comps, channels, bl, 0.0, 0.0).orderBy("chan").toPandas()
    freq = channels.orderBy("chan").toPandas().freq_hz.to_numpy()
    want = 2 * np.exp(2j * np.pi * 100 * np.sin(np.radians(0.01)) * freq / model.LIGHT)
    assert np.allclose(got.re + 1j * got.im, want, rtol=1e-6)
    assert model.parse_component("# note") is None
    assert not model.is_point(comps, 0.0, 0.0).first()[0]


def test_model_is_made_in_arrays_per_batch_of_baselines(spark, capsys):
    """Many baselines and components in blocks, one out of its band; a baseline without a place has no model, and no row carries the sky."""
    lines = [f"s{k}, radec, 0:0:{k}, 0:0:{7 * k}, 800 {1000 if k == 3 else 2000} wsclean {k + 1}.0 [] false 1284e6" for k in range(5)]
    comps = spark.createDataFrame([("m", k, *model.parse_component(x)) for k, x in enumerate(lines)], model.COMPONENT)
    channels = synthetic.channel_table(spark, 3, 856e6, 1284e6)
    rows = [(d, 0, 1, 10.0 * d, 100.0 - d, None if d == 7 else 0.5 * d) for d in range(300)]
    bl = spark.createDataFrame(rows, "dump int, ant1 int, ant2 int, u double, v double, w double")
    out = model.model_visibilities(comps, channels, bl, 0.0, 0.0)
    out.explain()
    assert "NestedLoopJoin" not in capsys.readouterr().out
    got = {(r.dump, r.chan): (r.re, r.im) for r in out.collect()}
    assert len(got) == 900
    sky = comps.toPandas()
    l, m = np.cos(sky.dec) * np.sin(sky.ra), np.sin(sky.dec)
    for c in channels.collect():
        flux = np.where(c.freq_hz / 1e6 <= sky.fmax_mhz, sky.s0, 0.0)
        for d, _, _, u, v, w in rows[::7] + rows[1::50]:
            if w is None:
                assert got[d, c.chan] == (None, None)
                continue
            want = (flux * np.exp(2j * np.pi * (u * l + v * m + w * (np.sqrt(1 - l * l - m * m) - 1)) * c.freq_hz / model.LIGHT)).sum()
            assert abs(complex(*got[d, c.chan]) - want) < 1e-9


def test_beam_fit_recovers_a_gaussian(spark):
    x, y = np.meshgrid([-1, -0.5, 0, 0.5, 1], [-1, -0.5, 0, 0.5, 1])
    amp = 3 * np.exp(-0.5 * (((x - 0.1) / 0.8) ** 2 + ((y + 0.2) / 0.6) ** 2))
    rows = [(0, 0, "h", float(a), float(b), float(c)) for a, b, c in zip(x.ravel(), y.ravel(), amp.ravel(), strict=True)]
    r = pointing.beam_fits(spark.createDataFrame(rows, "ant int, chunk int, pol string, x double, y double, amp double")).first()
    assert r.valid and np.allclose([r.x0, r.y0, r.wx, r.wy, r.height], [0.1, -0.2, 0.8, 0.6, 3.0], rtol=1e-4)


def test_errors_of_a_beam_equal_a_monte_carlo():
    """Predicted errors within a fifth of the scatter over many noisy beams, with weights and without."""
    rng = np.random.default_rng(8)
    x, y = (v.ravel() for v in np.meshgrid(np.linspace(-1, 1, 7), np.linspace(-1, 1, 7)))
    clean = 3 * np.exp(-0.5 * (((x - 0.1) / 0.8) ** 2 + ((y + 0.2) / 0.6) ** 2))
    sigma = np.where(x > 0, 0.02, 0.06)
    fits = [pointing.fit_beam(x, y, clean + sigma * rng.normal(size=len(x)), 1 / sigma**2) for _ in range(400)]
    assert all(ok for _, _, ok in fits)
    scatter, predicted = np.std([p for p, _, _ in fits], axis=0), np.mean([e for _, e, _ in fits], axis=0)
    assert np.allclose(predicted, scatter, rtol=0.2)
    even = [pointing.fit_beam(x, y, clean + 0.03 * rng.normal(size=len(x))) for _ in range(400)]
    assert np.allclose(np.mean([e for _, e, _ in even], axis=0), np.std([p for p, _, _ in even], axis=0), rtol=0.2)


def test_beams_that_cannot_be_fitted_are_not_valid():
    x, y = (v.ravel() for v in np.meshgrid([-1.0, 0.0, 1.0], [-1.0, 0.0, 1.0]))
    assert not pointing.fit_beam(x, y, np.ones(9))[2] and not pointing.fit_beam(x[:4], y[:4], np.ones(4))[2]
    beam = 3 * np.exp(-0.5 * (x**2 + y**2))
    assert pointing.fit_beam(x, y, beam, np.full(9, 1e4))[2] and not pointing.fit_beam(x, y, beam, np.full(9, 1e-4))[2]
    assert not pointing.fit_beam(x, y, beam, np.zeros(9))[2]


def test_flags_are_monotone():
    rng = np.random.default_rng(0)
    amp = rng.normal(1, 0.1, (20, 40))
    amp[5] += 20
    flagged = rng.random((20, 40)) < 0.2
    assert not (rfi.sum_threshold(amp, flagged) & flagged).any()


def test_poor_antennas(spark):
    rows = [(0, 1, 1.0, 0.0, 0, 1.0), (0, 2, 1.9, 0.0, 0, 1.0), (1, 2, 1.9, 0.0, 0, 1.0), (0, 3, 1.0, 0.0, 1, 1.0)]
    vis = spark.createDataFrame(rows, "ant1 int, ant2 int, re double, im double, flags int, weight double").withColumn("pol", F.lit("h"))
    gains = spark.createDataFrame([(a, "h", 1.0, 0.0) for a in range(4)], "ant int, pol string, re double, im double")
    got = {r.ant: r.poor for r in solve.poor_antennas(solve.residuals(vis, gains, []), ["pol"], 0.7).collect()}
    assert got == {0: False, 1: False, 2: True, 3: True}


def test_pointing_offsets(spark):
    got = pointing.offsets(spark.createDataFrame([(10.0, 1.0, 10.0, 0.0), (11.0, 0.0, 10.0, 0.0)], "az double, el double, target_az double, target_el double")).collect()
    assert np.allclose([got[0].x, got[0].y, got[1].x, got[1].y], [0, 1, 1, 0], atol=1e-9)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(7)
    data = {"a": rng.normal(size=3000), "b": np.repeat([1.0, 2.0, 2.0, 5.0], 250), "c": np.array([4.0]), "d": np.round(rng.random(999), 2)}
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("a", float("nan")), ("e", None)]
    from lodestone.operators import robust

    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: r for r in robust.quantiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", shares, [f"q{i}" for i in range(6)]).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        assert np.allclose([got[k][f"q{i}"] for i in range(6)], np.quantile(v, shares))


def test_delays_of_any_channels():
    """Channels 1 to 7 with any of them missing and unequal weights: the delay is that of all of them."""
    rng = np.random.default_rng(5)
    for chosen in range(1, 128):
        chans = np.flatnonzero([chosen >> k & 1 for k in range(7)])
        freq = 1281e6 + 1e6 * chans
        for delay in (6.5e-9, -3e-9, 0.0):
            x = np.exp(2j * np.pi * delay * freq) * rng.uniform(0.7, 1.3, len(chans))
            got = solve.delay_of(x, rng.uniform(1, 50, len(chans)), freq)
            assert abs(got - delay) < 1e-13 if len(chans) > 1 else np.isnan(got)
    freq, gap = 1281e6 + 1e6 * np.arange(7), np.array([1, 0, 0, 1, 0, 0, 1.0])
    far = np.exp(2j * np.pi * 4e-7 * freq)
    assert abs(solve.delay_of(far, np.ones(7), freq) - 4e-7) < 1e-13


def test_a_baseline_with_few_channels_takes_its_period_from_the_others(spark):
    """Baseline 1-2 has channels three steps apart, so its delay is open by a third of a microsecond; 0-1 and 0-2 settle it."""
    delays, chans = {0: 0.0, 1: 1.5e-7, 2: -1.5e-7}, {(0, 1): range(7), (0, 2): range(7), (1, 2): (0, 3, 6)}
    rows = [(1, c, "h", a, b, float(np.cos(t)), float(np.sin(t)), 0, 1.0) for (a, b), own in chans.items() for c in own for t in [2 * np.pi * (delays[a] - delays[b]) * (1281e6 + 1e6 * c)]]
    channels = spark.createDataFrame([(c, 1281e6 + 1e6 * c) for c in range(7)], "chan int, freq_hz double")
    vis = spark.createDataFrame(rows, "scan int, chan int, pol string, ant1 int, ant2 int, re double, im double, flags int, weight double")
    got = {r.ant: r.delay for r in solve.solve_delays(vis, channels, ["scan"], 3, 0).collect()}
    assert all(abs(got[a] - d) < 1e-12 for a, d in delays.items())


def test_quantiles_compare_a_row_with_few_cuts(spark):
    """A row meets two cuts a share, not the cuts of a whole histogram; the quantile is exact beside ties and one value alone."""
    from lodestone.operators import robust

    df = spark.range(20001).select((F.col("id") % 2).cast("string").alias("k"), F.when(F.col("id") % 7 == 0, 5.0).otherwise(F.col("id") * 1.0).alias("x"))
    out = robust.quantiles(df, ["k"], "x", [0.25, 0.5], ["q25", "q50"])
    assert "filter(_cuts" not in out._jdf.queryExecution().optimizedPlan().toString()
    pdf = df.toPandas()
    for r in out.collect():
        assert np.allclose([r.q25, r.q50], np.quantile(pdf[pdf.k == r.k].x, [0.25, 0.5]))


def test_many_beams_in_one_array_are_those_of_each_alone():
    """Padded points, too few of them and a plane that is no beam change nothing for the others."""
    from lodestone.operators import pointing

    x, y = (z.ravel() for z in np.meshgrid(np.linspace(-1, 1, 5), np.linspace(-1, 1, 5)))
    centres = np.linspace(-0.2, 0.2, 40)
    amp = np.stack([3 * np.exp(-0.5 * (((x - c) / 0.8) ** 2 + ((y + c) / 0.6) ** 2)) for c in centres])
    weight = np.ones_like(amp)
    weight[:20, 13:], weight[7, 3:], amp[11] = 0.0, 0.0, 1.0
    p, _, valid = pointing.fit_beams(np.tile(x, (40, 1)), np.tile(y, (40, 1)), amp, weight, True)
    assert [k for k in range(40) if not valid[k]] == [7, 11]
    for k in np.flatnonzero(valid):
        own = weight[k] > 0
        assert np.allclose(p[k], [centres[k], -centres[k], 0.8, 0.6, 3.0], atol=1e-6)
        assert np.allclose(p[k], pointing.fit_beam(x[own], y[own], amp[k, own])[0], atol=1e-9)

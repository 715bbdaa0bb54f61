"""Parameters, windows, files, streaming batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodestone import registry
from lodestone.operators import average, ingest, sensors
from lodestone.plans import params
from lodestone.sources import config, scratch
from lodestone.streaming import batcher

WIDE = params.Axis(32768, 856e6, 1284e6)


def test_wide_band_vectors():
    window = params.channel_window(WIDE, [856 + 856 * 18000 / 32768], [856 + 856 * 19601 / 32768])[0]
    assert window == (18000, 19600)
    got = params.flagger_widths(WIDE, 104491, 2089843, 391845, [1, 2, 4, 8])
    assert got["average"] == 4 and got["extend"] == 15 and got["windows"] == [1, 8, 16, 32]


def test_channel_form_wins_and_errors():
    axis = params.Axis(4096, 856e6, 1284e6, 4, 2)
    assert params.resolve_window(axis, {"g_bchan": 2100, "g_echan": 2300, "g_bfreq": [1000.0], "g_efreq": [1100.0]}, "g") == (2100, 2300)
    for bad in ({}, {"g_bchan": 5, "g_echan": 5}, {"g_bchan": 1000, "g_echan": 1100}):
        with pytest.raises(ValueError):
            params.resolve_window(axis, bad, "g")
    with pytest.raises(ValueError):
        params.Axis(4096, 856e6, 1284e6, 3, 0)
    with pytest.raises(ValueError):
        params.Axis(4096, 856e6, 1284e6, 4, 4)
    assert params.to_local(axis, 2250) == 202 and params.to_global(axis, 202) == 2250 and params.server_share(8, 4) == 2


def test_blank_windows():
    axis = params.Axis(32768, 1070e6, 1871.5e6, 4)
    mask = [5090 <= i < 5100 or 25000 <= i < 27100 for i in range(32768)]
    assert params.blank_window(axis, mask) == (9088, 15488)
    narrow = [m or 8192 <= i < 10092 or 16384 <= i < 18384 for i, m in enumerate(mask)]
    assert params.blank_window(axis, narrow) == (10092, 16383)
    with pytest.raises(ValueError):
        params.blank_window(axis, [True] * 32768)


def test_largest_window_of_a_table(spark):
    chans = spark.range(32768).select(F.col("id").alias("chan"), F.floor(F.col("id") / 8192).alias("server"))
    mask = (F.col("chan").between(5090, 5099)) | (F.col("chan").between(25000, 27099))
    r = sensors.largest_window(chans.withColumn("masked", mask), 6400).first()
    assert (r.server, r["first"], r["last"]) == (1, 9088, 15488)
    mask = mask | F.col("chan").between(8192, 10091) | F.col("chan").between(16384, 18383)
    r = sensors.largest_window(chans.withColumn("masked", mask), 6400).first()
    assert (r["first"], r["last"]) == (10092, 16383)


def test_intervals_start_with_each_scan(spark):
    rows = [(0, d) for d in range(100, 107)] + [(1, d) for d in range(203, 226)]
    df = spark.createDataFrame(rows, "scan int, dump int").selectExpr("*", "1.0d AS re", "0.0d AS im", "0 AS flags", "1.0d AS weight")
    got = {(r.scan, r.solint): r.mean_dump for r in average.wavg_solint(df, 10, [], ["scan"]).collect()}
    # 7 dumps are one interval; 23 are two of 12 and 11.
    assert got == {(0, 0): 103.0, (1, 0): 208.5, (1, 1): 220.0}


USER = {
    "k_solint": 5.0, "k_chan_sample": 1, "k_bfreq": [1326.2], "k_efreq": [1368.012], "kcross_chanave": 1, "bp_solint": 5.0, "g_solint": 5.0, "g_bfreq": [1326.2], "g_efreq": [1368.012],
    "rfi_calib_nsigma": 4.5, "rfi_targ_nsigma": 7.0, "rfi_windows_post_average": [1, 2, 4, 8], "rfi_average_hz": 104491, "rfi_targ_spike_width_hz": 4179687, "rfi_calib_spike_width_hz": 2089843,
    "rfi_spike_width_time": 100.0, "rfi_extend_hz": 391845, "rfi_freq_chunks": 8, "epoint_freq_chunks": 16, "bcross_sky_knots": [0.0] * 14, "bcross_sky_coefs": [0.0] * 14, "bcross_sky_k": 3,
}
L4 = params.Axis(4096, 856e6, 1284e6, 4, 2)


def test_parameters_of_a_server():
    got = params.resolve(L4, USER)
    assert (got["k_bchan"], got["k_echan"], got["g_bchan"], got["g_echan"]) == (202, 402, 202, 402)
    assert (got["rfi_freq_chunks"], got["epoint_freq_chunks"]) == (2, 4)
    wide = params.resolve(WIDE, USER)
    assert (wide["rfi_average_freq"], wide["rfi_extend_freq"], wide["rfi_windows_freq"]) == (4, 15, [1, 8, 16, 32])
    assert params.published(L4, got)["param_k_bchan"] == 2250 and params.published(L4, got)["param_rfi_freq_chunks"] == 8
    listed = USER | {"k_bfreq": [1112.1, 1326.2], "k_efreq": [1154.012, 1368.012], "subband_bfreq": [642.0, 856.0]}
    assert params.resolve(L4, listed)["k_bchan"] == 202
    assert params.resolve(L4, USER | {"g_bchan": 2100, "g_echan": 2300})["g_bchan"] == 52


def test_blank_windows_of_parameters():
    blank = USER | {"k_bfreq": [], "k_efreq": []}
    mask = [k in (500, 3100) for k in range(4096)]
    got = params.resolve(params.Axis(4096, 856e6, 1284e6, 4, 1), blank, mask)
    assert (got["k_bchan"], got["k_echan"]) == (0, 1023)
    assert params.blank_prefixes(blank) == ["k"] and params.blank_prefixes({"g_bchan": 5}) == []


@pytest.mark.parametrize("change", [{"k_bfreq": None}, {"k_efreq": [1315.0]}, {"k_efreq": [1498.3]}, {"foo": "bar"}, {"k_solint": None}, {"rfi_extend_hz": None}, {"k_bfreq": [1.0, 2.0]}])
def test_bad_parameters(change):
    bad = {k: v for k, v in (USER | change).items() if v is not None}
    with pytest.raises(ValueError):
        params.resolve(L4, bad)


def test_parameter_file():
    got = config.read_parameters(["a : 5 # five", "", "# note", "b : x, y"], {"a": int, "b": list})
    assert got == {"a": 5, "b": ["x", "y"]}
    with pytest.raises(ValueError):
        config.read_parameters(["c : 1"], {"a": int})
    assert config.override({"a": 1, "b": 2}, {"a": None, "b": 3}) == {"a": 1, "b": 3}
    assert config.parameter_set("l", 50e6) == "L_narrow_54" and config.parameter_set("u", 544e6) == "U_wide"


def test_model_choice():
    assert config.choose_model(["J1"], [["J1.txt"]], "l") == "J1.txt"
    assert config.choose_model(["J1"], [["J1_L.txt", "J1_U.txt"]], "u") == "J1_U.txt"
    assert config.choose_model(["J1"], [[], ["J1.txt"]], "u") == "J1.txt"
    assert config.choose_model(["J2"], [["J1.txt"]], "u") is None


def _serial(dumps, max_length):
    """Batches by a plain loop over one group's dumps."""
    batch, n, out, old = 0, 0, [], None
    for _, activity, at, tags in dumps:
        if old is not None and (batcher.breaks(old, (activity, at, tags)) or n >= max_length):
            batch, n = batch + 1, 0
        out.append(batch)
        n, old = n + 1, (activity, at, tags)
    return out


def test_window_form_equals_the_serial_rule(spark):
    rng = random.Random(5)
    groups, rows = {}, []
    for g in range(20):
        at, dumps = 0.0, []
        state = ("track", 0.0, "gaincal")
        for i in range(40):
            if rng.random() < 0.2:
                at = float(i)
                state = (rng.choice(["track", "slew", "stop", "scan"]), at, rng.choice(["gaincal", "target", "bpcal single_accumulation", "unknown"]))
            dumps.append((i, *state))
        groups[g] = dumps
        rows += [(g, *d) for d in dumps]
    df = spark.createDataFrame(rows, "g int, dump int, activity string, activity_time double, tags string")
    got = sensors.batches(df, ["g"], ["dump"], 6).orderBy("g", "dump").toPandas()
    for g, dumps in groups.items():
        mine = got[got.g == g]
        ids = (mine.session * 1000 + mine.batch).tolist()
        want = _serial(dumps, 6)
        assert [i for i in range(1, 40) if ids[i] != ids[i - 1]] == [i for i in range(1, 40) if want[i] != want[i - 1]]


def test_disorder_gap_fill_and_late_data():
    b = batcher.Batch()
    track = ("track", 0.0, "gaincal")
    rows = []
    for dump in (0, 1, 3, 2, 6):
        rows += sum(b.add(dump, 0, f"p{dump}", track, 100), [])
    rows += sum(b.add(7, 0, "p7", ("slew", 7.0, "gaincal"), 100), [])
    assert [(r[1], r[2]) for r in rows] == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 8), (5, 8), (6, 0)]
    assert list(b.add(3, 0, "late", track, 100)) == [] and b.late == 1


def test_size_limit_wraps():
    b = batcher.Batch()
    rows = []
    for dump in range(130):
        rows += sum(b.add(dump, 0, "x", ("track", 0.0, ""), 30), [])
    rows += b.close()
    assert len(rows) == 130 and max(r[0] for r in rows) == 4
    assert [r[1] for r in rows] == list(range(130))


def test_stream_of_files(spark, tmp_path):
    heap = "cb string, chan_group int, dump bigint, activity string, activity_time double, tags string, is_stop boolean, flags int, payload string"
    rows = [("cb", 0, d, "track", 0.0, "gaincal", False, 0, f"p{d}") for d in (0, 1, 2, 4)]
    spark.createDataFrame(rows, heap).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("cb", 0, None, "", 0.0, "", True, 0, None)], heap).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(heap).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = batcher.write_batches(batcher.batch_stream(stream, 60), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("dump").toPandas()
    assert out.dump.tolist() == [0, 1, 2, 3, 4] and out["flags"].tolist() == [0, 0, 0, 8, 0]


def _log():
    """Two groups of heaps in the order of a log: disorder, gaps, late ones, changes of activity, two endpoints' stops, heaps behind the last stop."""
    rng, rows = random.Random(11), []
    for g in (0, 1):
        dumps = [d for d in range(60) if rng.random() > 0.15]
        for k in range(0, len(dumps) - 3, 3):
            if rng.random() < 0.4:
                dumps[k], dumps[k + 2] = dumps[k + 2], dumps[k]
        dumps.insert(40, 2)
        for d in dumps:
            rows.append(("cb", g, d, "track", float(d // 13), "gaincal", False, 0, f"p{g}-{d}", len(rows), None))
        stop = lambda e: rows.append(("cb", g, None, None, None, None, True, None, None, len(rows), e))  # noqa: B023, E731
        stop(0)
        stop(0)
        rows.append(("cb", g, 61, "track", 4.0, "gaincal", False, 0, "between", len(rows), None))
        stop(1)
        rows.append(("cb", g, 70, "track", 5.0, "gaincal", False, 0, "behind", len(rows), None))
    return rows


@pytest.mark.parametrize("cuts", [[], [17, 50, 90], list(range(9, 100, 9))])
def test_batches_do_not_depend_on_micro_batches(spark, tmp_path, cuts):
    """One log in one, four and many files, one a micro-batch: the rows are those of the log read heap by heap."""
    log = _log()
    edges = [0, *cuts, len(log)]
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        part = spark.createDataFrame(random.Random(k).sample(log[a:b], b - a), batcher.HEAP)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batcher.HEAP).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    batcher.write_batches(batcher.batch_stream(stream, 20, endpoints=2), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(240)
    got = sorted((r.chan_group, r.batch, r.dump, r.flags, r.payload or "", r.too_late) for r in spark.read.schema(batcher.OUT).parquet(str(tmp_path / "out")).collect())
    want = []
    for g in (0, 1):
        b = batcher.Batch()
        for r in (r for r in log if r[1] == g and not b.ended):
            parts = [b.stop(r[10], 2)] if r[6] else b.add(r[2], r[7], r[8], (r[3], r[4], r[5]), 20)
            want += [(g, n, d, f, p or "", late) for part in parts for n, d, f, p, late in part]
    assert got == sorted(want)
    assert {r[4] for r in got} >= {"between"} and "behind" not in {r[4] for r in got} and max(r[5] for r in got) > 0


def test_state_survives_its_columns():
    b = batcher.Batch()
    list(b.add(3, 1, "x", ("track", 0.0, "t"), 9))
    b.stop(4, 2)
    again = batcher.Batch(*b.state())
    assert again.held == {3: (1, "x")} and again.stopped == [4] and again.state() == b.state()
    assert [r[1] for r in again.stop(5, 2)] == [3] and again.ended


def test_a_gap_is_a_few_runs(spark):
    """What the stateful step emits grows with the heaps, not with the lost dumps; rows of the runs are those of the batches."""
    track, far = ("track", 0.0, "gaincal"), 10_000_007
    b = batcher.Batch()
    runs = [r for dump in (3, 5, far) for some in b.take(dump, 0, f"p{dump}", track, 30) for r in some] + b.finish(0, 1)
    assert len(runs) < 200 and sum(r[6] - r[1] + 1 for r in runs) == far - 3 + 1 and b.batch == (far - 3) // 30 + 1
    b, want = batcher.Batch(), []
    for dump in (3, 5, 200_000):
        want += sum(b.add(dump, 0, f"p{dump}", track, 30), [])
    want += b.stop(0, 1)
    b = batcher.Batch()
    short = [r for dump in (3, 5, 200_000) for some in b.take(dump, 0, f"p{dump}", track, 30) for r in some] + b.finish(0, 1)
    got = batcher.dump_rows(spark.createDataFrame([("cb", 0, *r) for r in short], batcher.RUNS)).orderBy("dump").collect()
    assert [(r.batch, r.dump, r.flags, r.payload, r.too_late) for r in got] == want


def test_rows_of_runs_say_what_stands_for_nothing(spark):
    """A run's last batch may be short; payloads and controls that there aren't come out as the text given, before a row per dump is made."""
    runs = spark.createDataFrame([("cb", 0, 4, 10, 8, None, 2, None, 16, 3), ("cb", 0, 7, 17, 0, "p", 0, None, 17, 1), ("cb", 0, 7, 18, 0, None, 0, "sync", 18, 1)], batcher.RUNS)
    got = [(r.batch, r.dump, r.payload, r.control) for r in batcher.dump_rows(runs, "-").orderBy("dump").collect()]
    assert got == [(4 + k // 3, 10 + k, "-", "-") for k in range(7)] + [(7, 17, "p", "-"), (7, 18, "-", "sync")]


def test_fill_gaps_marks_lost(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 0), ("a", 4, 6.0, 2)], "k string, i int, v double, flags int")
    got = sensors.fill_gaps(df, ["k"], "i", ["v"], 8).orderBy("i").collect()
    assert [(r.i, r.v, r.flags) for r in got] == [(1, 5.0, 0), (2, None, 8), (3, None, 8), (4, 6.0, 2)]
    assert sensors.fill_gaps(df.limit(0), ["k"], "i", ["v"], 8).count() == 0


def test_counts_of_a_filled_series_without_its_rows(spark):
    """A gap of 10^12 indices is counted from its ends; the counts are those of the filled rows where there are any to make."""
    df = spark.createDataFrame([("a", 1, 5.0, 0), ("a", 4, 6.0, 8), ("a", 5, 7.0, 0), ("b", 2, 1.0, 0)], "k string, i bigint, v double, flags int")
    filled = sensors.fill_gaps(df, ["k"], "i", ["v"], 8).groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("flags") == 8).alias("lost"), F.sum("v").alias("v"))
    counted = lambda d: d.groupBy("k").agg(F.sum(1 + F.col("lost_after")).alias("n"), F.sum("lost_after").alias("lost"), F.sum("v").alias("v"))
    flagged = df.where("flags = 8").groupBy("k").count()
    got = {r.k: r for r in counted(sensors.gaps(df, ["k"], "i")).collect()}
    for r in filled.collect():
        own = flagged.where(F.col("k") == r.k).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        assert (r.n, r.lost, r.v) == (got[r.k].n, got[r.k].lost + own, got[r.k].v)
    wide = spark.createDataFrame([("a", 0, 1.0), ("a", 10**12, 2.0)], "k string, i bigint, v double")
    assert counted(sensors.gaps(wide, ["k"], "i")).first()[1:] == (10**12 + 1, 10**12 - 1, 3.0)


def test_asof_before_first_is_null(spark):
    left = spark.createDataFrame([(1, 5), (1, 15)], "k int, ts int")
    right = spark.createDataFrame([(1, 10, "x")], "k int, ts int, v string")
    got = sensors.asof(left, right, ["k"], "ts", ["v"]).orderBy("ts").collect()
    assert [r.v for r in got] == [None, "x"]
    assert sensors.asof(left, right.where(F.lit(False)), ["k"], "ts", ["v"]).where("v IS NOT NULL").count() == 0


def test_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(scratch, "ROWS", 100)
    dealt = scratch.dealt(spark.range(4000), "id")
    sizes = [len(x) for x in dealt.rdd.glom().collect()]
    assert len(sizes) == 40 and sum(sizes) == 4000 and max(sizes) < 200


@pytest.mark.parametrize("name", ["divide_model", "excision_bytes", "excision_sent"])
def test_tasks_of_long_tables_stay_small(spark, monkeypatch, capsys, name):
    """With tables too long to be broadcast unasked: rows aren't joined by the few keys of a dimension, and groups are dealt by the number of rows."""
    monkeypatch.setattr(scratch, "ROWS", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        registry.queries()[name](spark, "/root/testdata/sf0.001").explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "REPARTITION_BY_NUM" in plan


def test_bits_of_repeated_positions_are_set_once(spark):
    """Rows of one position are one bit, so cells needn't be grouped before they are packed."""
    bits = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (1, 0, 0), (1, 3, 1), (1, 9, 1), (1, 9, 1), (2, 8, 0)], "dump int, idx long, bit int")
    assert sorted(map(tuple, ingest.pack_bits(bits, ["dump"], "idx", "bit").collect())) == [(1, 0, 0b10010000), (1, 1, 0b01000000), (2, 1, 0)]

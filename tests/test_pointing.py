"""Reference pointing: offsets there and back, what a sync takes, and beams from a stream with control rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone import pointing_queries as data
from lodestone.operators import astro, pointing
from lodestone.plans import pointing as plan
from lodestone.plans import reduction
from lodestone.streaming import batcher, incremental

ANTS, GRID = 4, [(0.5 * i, 0.5 * j) for j in (-1, 0, 1) for i in (-1, 0, 1)]
T0 = 1.7e9


def _beam(ant, x, y):
    return (2 + 0.5 * ant) * np.exp(-0.5 * (((x - 0.1 * ant) / 0.8) ** 2 + ((y + 0.05 * ant) / 0.6) ** 2))


def test_offsets_there_and_back(spark):
    rows = [(x, y, az, el) for x in (-1.0, 0.0, 0.7) for y in (-0.4, 0.0, 1.0) for az, el in ((0.1, 40.0), (359.9, 70.0), (180.0, 10.0))]
    got = pointing.offsets(pointing.directions(spark.createDataFrame(rows, "x double, y double, target_az double, target_el double")).withColumnsRenamed({"x": "x0", "y": "y0"})).collect()
    assert all(abs(r.x - r.x0) < 1e-9 and abs(r.y - r.y0) < 1e-9 and 0 <= r.az < 360 for r in got) and len(got) == len(rows)


def test_what_a_sync_takes(spark):
    pointings = spark.createDataFrame([("a", b, 10 * b) for b in (0, 1, 3, 4, 7)] + [("b", 1, 99)], "cb string, batch bigint, scan bigint")
    syncs = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("c", 5)], "cb string, batch bigint")
    got = {(r.cb, r.scan): r.sync for r in plan.taken_by(pointings, syncs).collect()}
    # Scan 70, and the capture block without a sync, still wait.
    assert got == {("a", 0): 1, ("a", 10): 1, ("a", 30): 4, ("a", 40): 4}
    assert plan.taken_by(pointings, syncs.limit(0)).isEmpty()


def test_chunks_by_weight(spark):
    rows = [(0, "h", 0, c, 2.0 + 0.1 * (-1) ** c, 0.0) for c in range(4)] + [(0, "v", 0, c, 0.0, 4.0 + 0.2 * (-1) ** c) for c in range(4)] + [(0, "h", 0, 4, None, None), (0, "h", 0, 5, float("nan"), 0.0)]
    got = pointing.chunk_amplitudes(spark.createDataFrame(rows, "scan int, pol string, ant int, chan int, re double, im double"), ["scan"], 4).collect()
    w = np.array([4 / 0.01, 4 / 0.04])
    assert len(got) == 1 and np.isclose(got[0].amp, (w * [2, 4]).sum() / w.sum()) and np.isclose(got[0].weight, w.sum())


def test_control_rows_of_batches():
    b, rows = batcher.Batch(), []
    for dump, activity in enumerate(("track", "track", "await_pipeline", "slew", "track", "slew")):
        rows += sum(b.add(dump, 0, "p", (activity, float(dump), "pointingcal"), 30), [])
    # Between two tracks' own change of time a batch breaks; only the one that waits has a control row, behind its batch.
    assert [(r[0], r[1]) for r in rows if r[-1] == batcher.SYNC] == [(1, 2)]
    assert [(r[0], r[1]) for r in rows if r[-1] != batcher.SYNC] == [(0, 0), (1, 1), (2, 2), (2, 3), (2, 4)]


def _heaps():
    """A dump per pointing and one in which the pipeline is awaited, twice; nine more pointings wait."""
    rows = []
    for k in range(30):
        at = k % 10
        activity = "await_pipeline" if at == 9 else "track"
        rows.append(("cb", 0, k, activity, float(k), "pointingcal", False, 0, str(at), k, None))
    return rows[:-1] + [("cb", 0, None, None, None, None, True, None, None, 30, None)]


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("heaps")
    spark.createDataFrame(_heaps(), batcher.HEAP).coalesce(1).write.parquet(str(folder / "in"))
    stream = spark.readStream.schema(batcher.HEAP).parquet(str(folder / "in"))
    batcher.write_batches(batcher.batch_stream(stream, 60), str(folder / "out"), str(folder / "check")).awaitTermination()
    return spark.read.schema(batcher.OUT).parquet(str(folder / "out")).cache()


def _visibilities(spark, batches):
    """A scan per dump of the batches, with the beams' gains on two channels and polarisations; control rows as they are."""
    cells = [(a, b, c, p) for a in range(ANTS) for b in range(a + 1, ANTS) for c in range(2) for p in "hv"]
    rows = []
    for r in batches.collect():
        tags = ["target"] if r.payload == "9" else ["pointingcal"]
        common = dict(cb=r.cb, scan=None if r.control else r.dump, batch=r.batch, target="beacon", tags=tags, ts=T0 + 60.0 * r.dump, dump=r.dump, control=r.control)
        if r.control:
            rows.append(common)
            continue
        x, y = GRID[int(r.payload)] if r.payload != "9" else (0.0, 0.0)
        rows += [common | dict(chan=c, pol=p, ant1=a, ant2=b, re=float(_beam(a, x, y) * _beam(b, x, y)), im=0.0, flags=0, weight=1.0) for a, b, c, p in cells]
    schema = "cb string, scan bigint, batch bigint, target string, tags array<string>, ts double, dump bigint, control string, chan int, pol string, ant1 int, ant2 int, re double, im double, flags int, weight double"
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _site(spark):
    rows = [("cb", T0 + 60.0 * k - 1, *GRID[k % 10]) for k in range(30) if k % 10 < 9]
    az, el = astro.apparent_az_el(F.col("ts") + 1, F.lit(data.RA), F.lit(data.DEC), data.LATITUDE, data.LONGITUDE)
    log = spark.createDataFrame(rows, "cb string, ts double, x double, y double").withColumns({"target_az": az, "target_el": el})
    track = pointing.directions(spark.createDataFrame(log.collect(), log.schema))
    air = spark.createDataFrame([("cb", T0 - 100, 0.0, 15.0)], "cb string, ts double, pressure_mb double, celsius double")
    places = spark.createDataFrame([("beacon", data.RA, data.DEC)], "target string, ra double, dec double")
    return plan.Site(data.LATITUDE, data.LONGITUDE, track.select("cb", "ts", "az", "el"), places, air, 2)


def _beams(store):
    return {(r.sync, r.pol, r.ant): r for r in store.read("EPOINT").collect()}


def test_pointing_end_to_end(spark, batches, tmp_path):
    vis = _visibilities(spark, batches).cache()
    syncs = sorted(r.batch for r in batches.where("control = 'sync'").collect())
    assert len(syncs) == 2
    channels = spark.createDataFrame([(0, 1.28e9), (1, 1.281e9)], "chan int, freq_hz double")
    store = incremental.Store(spark, "file://" + str(tmp_path / "store")).open()
    step = incremental.reducer(store, channels, ANTS, 0, reduction.Settings(), site=_site(spark))
    # Cut within the second set of pointings; its first part waits for the sync of the next micro-batch.
    cut = F.col("dump") <= 14
    source, check = str(tmp_path / "in"), "file://" + str(tmp_path / "check")
    vis.where(cut).write.parquet(source)
    incremental.reduce_stream(spark.readStream.schema(vis.schema).parquet(source), step, check).awaitTermination()
    assert {k[0] for k in _beams(store)} == {syncs[0]}
    vis.where(~cut).write.mode("append").parquet(source)
    incremental.reduce_stream(spark.readStream.schema(vis.schema).parquet(source), step, check).awaitTermination()
    got = _beams(store)
    assert set(got) == {(s, p, a) for s in syncs for p in "hv" for a in range(ANTS)}
    for (_, _, a), r in got.items():
        assert r.valid and np.allclose([r.x0, r.y0, r.wx, r.wy, r.height], [0.1 * a, -0.05 * a, 0.8, 0.6, 2 + 0.5 * a], atol=1e-4)
        assert r.height_snr > 10 and r.target == "beacon" and r.chunk == 0
    # What came after the last sync still waits; the micro-batch again changes nothing.
    assert store.read("B_POINTING").select("scan").distinct().count() == 27
    step(vis.where(~cut), 1)
    assert _beams(store) == got
    # A micro-batch of a control row alone finishes what waits.
    last = vis.agg(F.max("batch")).first()[0]
    lone = vis.where("control = 'sync'").limit(1).withColumn("batch", F.lit(last))
    step(lone, 2)
    assert {k[0] for k in _beams(store)} == {*syncs, last}

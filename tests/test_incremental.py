"""Batches reduced one by one against one plan over all of them; replays; merged summaries."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import average
from lodestone.plans import reduction
from lodestone.sources import synthetic
from lodestone.streaming import incremental

CHANS, DUMPS, ANTS = 16, 4, 4
TAGS = ["delaycal bpcal gaincal", "gaincal", "target"]


@pytest.fixture(scope="module")
def observed(spark):
    """Three batches of a scan each; the source's gains differ from scan to scan, and a cell in nine is flagged."""
    v = synthetic.visibilities(spark, synthetic.Truth(n_ants=ANTS, seed=3), CHANS, DUMPS * len(TAGS)).where("pol1 = pol2").withColumn("pol", F.col("pol1"))
    scan = F.floor(F.col("dump") / DUMPS).cast("int")
    v = v.withColumns({"scan": scan, "batch": scan, "cb": F.lit("one"), "flags": ((F.col("dump") * 5 + F.col("chan")) % 9 == 0).cast("int")})
    v = v.withColumn("re", F.col("re") * (1 + 0.1 * F.col("scan"))).withColumn("im", F.col("im") * (1 + 0.1 * F.col("scan")))
    v = v.withColumns({"target": F.concat(F.lit("t"), (F.col("scan") % 2).cast("string")), "tags": F.split(F.element_at(F.array(*(F.lit(t) for t in TAGS)), F.col("scan") + 1), " ")})
    return v.select("ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight", *incremental.SCAN).cache()


def _rows(df, digits=6):
    """Rows of a table but for the ratio to a noise that isn't there; delays in ps."""
    pdf = df.toPandas()
    if "delay" in pdf:
        pdf["delay"] *= 1e12
    pdf = pdf[sorted(c for c in pdf.columns if c not in ("epoch", "snr"))].round(digits)
    return sorted(repr([None if x is None or x != x else x + 0.0 if isinstance(x, float) else x for x in r]) for r in pdf.astype(object).itertuples(index=False, name=None))


def test_batches_one_by_one_equal_the_whole_and_replays_change_nothing(spark, observed, tmp_path):
    channels = synthetic.channel_table(spark, CHANS, 856e6, 1284e6)
    # A model of nothing but ones leaves the data; its running mean is one.
    model = observed.select("dump", "chan", "ant1", "ant2").distinct().withColumns({"re": F.lit(1.0), "im": F.lit(0.0)})
    scans = observed.groupBy("cb", "scan", "batch", "target", "tags").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    whole = reduction.reduce_scans(observed.drop("scan", "batch", "target", "tags"), scans, channels, ANTS, 0, model=model)
    store = incremental.Store(spark, "file://" + str(tmp_path / "store")).open()
    step = incremental.reducer(store, channels, ANTS, 0, model=model, block=4)
    source, check = str(tmp_path / "in"), "file://" + str(tmp_path / "check")
    for part in ("scan = 0", "scan > 0"):
        observed.where(part).write.mode("append").parquet(source)
        incremental.reduce_stream(spark.readStream.schema(observed.schema).parquet(source), step, check).awaitTermination()
    assert sorted(r.epoch for r in store.read("scans").select("epoch").distinct().collect()) == [0, 1]
    before = {n: _rows(store.read(n)) for n in incremental.TABLES}
    for name in ("K", "B", "G", "corrected"):
        assert len(before[name]) and before[name] == _rows(whole[name].select(*(c.split()[0] for c in incremental.TABLES[name].split(", "))))
    sums = incremental.merged(store)
    flat = whole["corrected"].join(scans.select("scan", "cb", "target", "tags"), "scan")
    want = flat.withColumn("block", F.floor(F.col("chan") / 4).cast("int")).groupBy("cb", "block", "pol", "ant1", "ant2").agg(F.sum("flags").alias("n_flagged"), F.count("*").alias("n"), F.avg("flags").alias("share"))
    assert _rows(sums["flags"]) == _rows(want)
    calibrated = average.per_antenna(flat.where("ant1 <> ant2 AND scan < 2"))
    assert _rows(sums["spectra"]) == _rows(average.wavg(calibrated, ["cb", "target", "chan", "pol", "ant"]))
    assert sums["scan_means"].select("scan").distinct().count() == 3 and sums["scan_means"].count() == 3 * 2 * 6
    ones = sums["models"].collect()
    assert len(ones) == 2 * CHANS and all(r.re == 1 and r.im == 0 for r in ones)
    assert {r.target: r.n for r in ones} == {"t0": 2 * DUMPS * 10, "t1": DUMPS * 10}
    # The second micro-batch again, as after a failure.
    step(observed.where("scan > 0"), 1)
    assert before == {n: _rows(store.read(n)) for n in incremental.TABLES}
    with pytest.raises(ValueError, match="more than one micro-batch"):
        step(observed.where("scan = 1"), 2)
    # The target has its own target's gains, of the first micro-batch.
    assert np.isclose(whole["corrected"].where("scan = 2 AND flags = 0 AND ant1 <> ant2").agg(F.avg("re")).first()[0], 1.2, rtol=1e-2)


def test_columns_of_a_stream():
    assert incremental.missing_columns(["ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight", "cb", "scan"]) == ["batch", "target", "tags"]


def test_rows_that_know_their_scan_are_not_sought_by_time(spark, monkeypatch):
    """A micro-batch is written once, as the table that every step reads: neither a search by time nor a second copy of its rows."""
    from lodestone import calibration_queries as q
    from lodestone.sources import scratch

    copies, plain = [], scratch.together
    monkeypatch.setattr(reduction, "together", lambda df, label, *a: copies.append(label) or plain(df, label, *a))
    monkeypatch.setattr(reduction, "with_scans", lambda *a: pytest.fail("rows were sought by time"))
    rows = q.observation(spark, "/root/testdata/sf0.001").where("scan < 3")
    told = rows.join(q.scans(rows).select("scan", "batch", "target", "tags"), "scan").withColumn("cb", F.lit("cb"))
    store = incremental.Store(spark, scratch.shared_path(spark, "store")).open()
    incremental.reducer(store, q.channels(spark), q.ANTS, q.REF, q.SETTINGS)(told, 0)
    assert copies == ["rows"] and store.read("corrected").count() == rows.count()
    kinds = {r.target: r.tags for r in store.read("scans").collect()}
    assert kinds == {r.target: r.tags for r in q.scans(rows).collect()}

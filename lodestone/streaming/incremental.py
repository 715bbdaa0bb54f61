"""Reduction of a stream, batch by batch, with solutions and summaries kept between the batches.

Every micro-batch of visibilities is reduced with the solutions of the ones before it, so its scans see what they would
have seen in one plan over the whole observation.  What comes out is kept in tables of one folder, a partition per
micro-batch which is replaced as a whole: a micro-batch that is replayed after a failure changes nothing.  The table ``done``
is written last and marks the micro-batch as complete.

Summaries are of four kinds, and merge over the micro-batches in any order:

* ``flags``: sums, per channel block, polarisation and baseline;
* ``spectra``: weighted means, kept as sums, per target, channel, polarisation and antenna of the calibrated scans;
* ``models``: running means, kept as a count and sums, per target and channel;
* ``scan_means``: rows that are appended, per scan, polarisation and baseline.

Control rows of the stream (``control`` is ``sync``, with cb and batch; see ``batcher``) finish reference pointing: the
bandpasses of ``pointingcal`` scans wait in B_POINTING, over micro-batches if need be, and a sync turns those of its capture
block that no earlier sync took into beams, EPOINT.  Nothing is deleted: which are still waiting follows from the table of
syncs.  A sync comes in the micro-batch of its batch or a later one.

A scan lies in one micro-batch, as ``batcher`` emits its batches; one that comes back in a later micro-batch is an error.
An empty micro-batch leaves no rows.  Rows without a scan or time belong to no scan and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import average
from lodestone.plans import pointing, reduction
from lodestone.sources.scratch import written
from lodestone.streaming import batcher

_SUMS = "swr double, swi double, sw double, n_flagged bigint, n bigint"
TABLES = {
    "scans": "scan bigint, batch bigint, cb string, target string, tags array<string>, t0 double, t1 double",
    "K": "scan bigint, pol string, ant int, delay double, snr double",
    "B": "scan bigint, chan int, pol string, ant int, re double, im double",
    "G": "scan bigint, solint int, time double, pol string, ant int, re double, im double, snr double",
    "corrected": "scan bigint, ts double, dump bigint, chan int, pol string, ant1 int, ant2 int, re double, im double, flags int, weight double",
    "B_POINTING": "cb string, batch bigint, target string, scan bigint, time double, chan int, pol string, ant int, re double, im double",
    "syncs": "cb string, batch bigint",
    "EPOINT": "cb string, sync bigint, time double, target string, chunk int, pol string, ant int, x0 double, y0 double, wx double, wy double, height double, valid boolean, x0_snr double, y0_snr double, wx_snr double, wy_snr double, height_snr double",
    "done": "complete boolean",
    "flags": "cb string, block int, pol string, ant1 int, ant2 int, n_flagged bigint, n bigint",
    "spectra": f"cb string, target string, chan int, pol string, ant int, {_SUMS}",
    "models": "cb string, target string, chan int, n bigint, sr double, si double",
    "scan_means": "cb string, scan bigint, target string, time double, pol string, ant1 int, ant2 int, re double, im double, weight double, flags int",
}
#: Columns that a stream has besides those of ``reduce_scans``.
SCAN = ("cb", "scan", "batch", "target", "tags")


@dataclass(frozen=True)
class Store:
    """Tables of one observation stream in a folder that driver and executors share."""

    spark: SparkSession
    root: str

    def open(self) -> Store:
        """Empty tables where there are none, so that the first micro-batch finds them."""
        for name, schema in TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{name}/epoch=-1")
        return self

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """Rows of the micro-batches (column ``epoch``) before one, or of all complete ones."""
        rows = self.spark.read.schema(f"{TABLES[name]}, epoch int").parquet(f"{self.root}/{name}")
        if before is not None:
            return rows.where(F.col("epoch") < before)
        return rows if name == "done" else rows.join(self.read("done"), "epoch", "left_semi")

    def put(self, name: str, rows: DataFrame, epoch: int) -> DataFrame:
        """Replace a micro-batch's rows; what was written, read back."""
        fields = [c.split(" ", 1) for c in TABLES[name].split(", ")]
        path = f"{self.root}/{name}/epoch={epoch}"
        rows.select(*(F.col(c).cast(t).alias(c) for c, t in fields)).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(TABLES[name]).parquet(path)


def summaries(corrected: DataFrame, scans: DataFrame, model: DataFrame | None, block: int) -> dict[str, DataFrame]:
    """The mergeable summaries of some scans; ``corrected`` has whole scans."""
    rows = corrected.join(scans.select("scan", "cb", "target", "tags"), "scan")
    cells = rows.withColumn("block", F.floor(F.col("chan") / block).cast("int"))
    flags = cells.groupBy("cb", "block", "pol", "ant1", "ant2").agg(F.sum((F.col("flags") != 0).cast("long")).alias("n_flagged"), F.count("*").alias("n"))
    cross = rows.where("ant1 <> ant2")
    spectra = average.partial_sums(average.per_antenna(cross.where(reduction.has_any(reduction.GAIN_TAGS))), ["cb", "target", "chan", "pol", "ant"])
    means = average.wavg(cross, ["cb", "scan", "target", "pol", "ant1", "ant2"], 1.0, F.avg("ts").alias("time"))
    out = {"flags": flags, "spectra": spectra, "scan_means": means}
    if model is not None:
        dumps = rows.select("cb", "target", "dump").distinct()
        seen = model.select("dump", "chan", F.col("re").alias("r"), F.col("im").alias("i")).join(dumps, "dump")
        out["models"] = seen.groupBy("cb", "target", "chan").agg(F.count("r").alias("n"), F.sum("r").alias("sr"), F.sum("i").alias("si"))
    return out


def merged(store: Store) -> dict[str, DataFrame]:
    """The summaries of all complete micro-batches: flags (and share), spectra, models, scan_means."""
    total = lambda name, keys, cols: store.read(name).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in cols))
    flags = total("flags", ["cb", "block", "pol", "ant1", "ant2"], ["n_flagged", "n"]).withColumn("share", F.col("n_flagged") / F.col("n"))
    spectra = average.finish(average.merge_sums(store.read("spectra"), ["cb", "target", "chan", "pol", "ant"]))
    models = total("models", ["cb", "target", "chan"], ["n", "sr", "si"])
    models = models.select("cb", "target", "chan", "n", (F.col("sr") / F.col("n")).alias("re"), (F.col("si") / F.col("n")).alias("im"))
    return {"flags": flags, "spectra": spectra, "models": models, "scan_means": store.read("scan_means").drop("epoch")}


def reducer(store: Store, channels: DataFrame, n_ants: int, ref: int, settings: reduction.Settings = reduction.Settings(), model: DataFrame | None = None, block: int = 64, site: pointing.Site | None = None) -> Callable[[DataFrame, int], None]:
    """The function of ``foreachBatch``: reduce a micro-batch and keep its products and summaries; with a ``site``, fit the pointings that its control rows finish."""

    def step(micro: DataFrame, epoch: int) -> None:
        # A table of the other tables' session; a micro-batch has its own.
        told, tiles = reduction.kept(micro, store.spark)
        control = F.col("control") if "control" in micro.columns else F.lit(None)
        rows = told.where(control.isNull() & F.expr("scan IS NOT NULL AND ts IS NOT NULL")).drop("control")
        # By what a scan's rows share first: first values of texts and lists would sort all rows.
        shared = rows.groupBy("cb", "scan", "batch", "target", "tags").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
        scans = shared.groupBy("cb", "scan", "batch").agg(F.first("target").alias("target"), F.first("tags").alias("tags"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))
        scans = written(scans, "scans")
        earlier = {name: store.read(name, epoch).drop("epoch") for name in ("scans", "K", "B", "G")}
        cut = scans.join(earlier["scans"], ["cb", "scan"], "left_semi")
        if not cut.isEmpty():
            raise ValueError(f"a scan came in more than one micro-batch, e.g. {cut.first().asDict()}")
        blocks = scans.select("cb").distinct()
        earlier["scans"] = earlier["scans"].join(blocks, "cb", "left_semi")
        out = reduction.reduce_scans(rows.drop("batch", "target", "tags"), scans, channels, n_ants, ref, settings, model, earlier=earlier, tiles=tiles)
        for name in ("K", "B", "G"):
            store.put(name, out[name], epoch)
        corrected = store.put("corrected", out["corrected"], epoch)
        for name, part in summaries(corrected, scans, model, block).items():
            store.put(name, part, epoch)
        if "B_POINTING" in out:
            store.put("B_POINTING", out["B_POINTING"].join(scans.select("scan", "cb", "batch", "target"), "scan"), epoch)
        syncs = store.put("syncs", told.where(control == batcher.SYNC).select("cb", "batch").distinct(), epoch)
        if site is not None and not syncs.isEmpty():
            both = {n: store.read(n, epoch + 1).drop("epoch") for n in ("B_POINTING", "syncs")}
            own = syncs.select("cb", F.col("batch").alias("sync"))
            beams = pointing.fit_pointings(both["B_POINTING"].join(own.select("cb").distinct(), "cb", "left_semi"), both["syncs"], site)
            store.put("EPOINT", beams.join(own, ["cb", "sync"], "left_semi"), epoch)
        store.put("scans", scans, epoch)
        store.put("done", store.spark.range(1).select(F.lit(True).alias("complete")), epoch)

    return step


def missing_columns(columns: Sequence[str]) -> list[str]:
    """Columns that a stream lacks to be reduced."""
    return [c for c in ("ts", "dump", "chan", "pol", "ant1", "ant2", "re", "im", "flags", "weight", *SCAN) if c not in columns]


def reduce_stream(vis: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True):
    """Start the reduction of a stream with the columns of ``reduce_scans`` and of ``SCAN``; ``checkpoint`` belongs to one store."""
    if lacking := missing_columns(vis.columns):
        raise ValueError(f"the stream lacks {lacking}")
    writer = vis.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

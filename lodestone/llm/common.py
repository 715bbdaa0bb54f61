"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow slice handed to a kernel; texts can be long, so kernels work on slices.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch sent to a Python task: with the default a batch holds 10,000 rows however long.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes too, so long texts and sets don't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local master gets a temporary folder; a cluster gets an error.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path is None:
        path = spark.conf.get("lodestone.local.checkpoint.dir", None)
        if path is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            path = "file://" + tempfile.mkdtemp(prefix="lodestone-")
            spark.conf.set("lodestone.local.checkpoint.dir", path)
    return path.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[0].rstrip("/").endswith(shared_dir(spark).split(":", 1)[-1].lstrip("/")):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of 64 bits of ``hash_filter``: its size is bounded whatever the number of hashes.
FILTER_ROWS = 1 << 18


def hash_filter(hashes: DataFrame) -> DataFrame:
    """(_place, _bits) of one column of 64-bit hashes: at most ``FILTER_ROWS`` rows, so it can be broadcast."""
    (h,) = hashes.columns
    bit = F.expr(f"shiftleft(1L, CAST(`{h}` & 63 AS INT))")
    return hashes.select(F.pmod(F.shiftright(h, 6), F.lit(FILTER_ROWS)).alias("_place"), bit.alias("_bit")).groupBy("_place").agg(F.bit_or("_bit").alias("_bits"))


def maybe_in(df: DataFrame, h: Column, bits: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: false only where the hash isn't in the filter."""
    rows = df.withColumn("_h", h).withColumn("_place", F.pmod(F.shiftright("_h", 6), F.lit(FILTER_ROWS)))
    hit = F.coalesce(F.getbit("_bits", F.col("_h").bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
    return rows.join(F.broadcast(bits), "_place", "left").withColumn("_maybe", hit).drop("_h", "_place", "_bits")


def without(df: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """Rows whose keys aren't a row of ``gone``; only those that a bounded filter of hashes can't clear are shuffled."""
    own, other = [f"_k{k}" for k in range(len(keys))], [f"_g{k}" for k in range(len(keys))]
    bits = hash_filter(gone.select(F.xxhash64(*gone.columns).alias("h")))
    marked = maybe_in(df.withColumns(dict(zip(own, keys, strict=True))), F.xxhash64(*own), bits)
    same = [F.col(a) == F.col(b) for a, b in zip(own, other, strict=True)]
    left = marked.where("_maybe").join(gone.toDF(*other), same, "left_anti")
    return marked.where("NOT _maybe").unionByName(left).select(df.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def give_back() -> None:
    """Return a worker's freed memory to the machine; reused workers otherwise keep what their largest slice took."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows (every row is kept)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Text bytes per slice of ``byte_slices``.
SLICE_BYTES = 4 << 20


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` has about ``most`` bytes in each slice, one row at least."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to

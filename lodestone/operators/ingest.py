"""Ingest and output of heaps: excision bits, product order, attributes, solution series, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def excised(flags: Column, is_excised: Column) -> Column:
    """Excision of a cell: any flag, in a stream whose data are excised."""
    return is_excised & (flags != 0)


def pack_bits(df: DataFrame, keys: Sequence[str], position: str, bit: str) -> DataFrame:
    """(keys, byte, value): bits by position, eight to a byte, the first one highest; a position's bit is set if any of its rows has it."""
    shifted = F.expr(f"shiftleft(CAST(`{bit}` AS INT), 7 - CAST(`{position}` % 8 AS INT))")
    return df.groupBy(*keys, F.floor(F.col(position) / 8).cast("long").alias("byte")).agg(F.bit_or(shifted).alias("value"))


def unpack_bits(packed: DataFrame, position: str, bit: str) -> DataFrame:
    """A row per bit of ``pack_bits``; the last byte's unused bits come as zeros."""
    rows = packed.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(7))))
    value = F.expr("shiftright(value, 7 - _k) & 1")
    return rows.select(*[c for c in packed.columns if c not in ("byte", "value")], (F.col("byte") * 8 + F.col("_k")).alias(position), value.alias(bit))


def restore_order(df: DataFrame, order: DataFrame, position: str = "idx") -> DataFrame:
    """Rows at ``position`` of the internal product order at the input's (``order``: idx, input_idx)."""
    return df.join(order.withColumnRenamed("idx", position), position).drop(position).withColumnRenamed("input_idx", position)


def subtable(spark: SparkSession, folder: str, keyword: str) -> DataFrame:
    """The dimension table that a keyword names."""
    if not keyword.isidentifier():
        raise ValueError(f"{keyword!r} names no table")
    return spark.read.parquet(f"{folder}/{keyword}.parquet")


def split_attributes(rows: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(static, timestamped, missing): attributes without and with a time, and required keys that no row has."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(k,) for k in required], "key string")
    return rows.where("ts IS NULL").drop("ts"), rows.where("ts IS NOT NULL"), wanted.join(rows, "key", "left_anti").select("key")


def solution_rows(series: DataFrame) -> DataFrame:
    """(key, ts, value) of series (key, times, values, snr arrays): a row per time, the SNR under its derived key."""
    from lodestone.functions.keys import snr_key

    values = series.select("key", F.explode(F.arrays_zip("times", F.col("values").alias("v"))).alias("x")).select("key", F.col("x.times").alias("ts"), F.col("x.v").alias("value"))
    snr = series.where("snr IS NOT NULL").select(snr_key(F.col("key")).alias("key"), F.explode(F.arrays_zip("times", "snr")).alias("x")).select("key", F.col("x.times").alias("ts"), F.col("x.snr").alias("value"))
    return values.unionByName(snr)


def blank_windows(params: DataFrame) -> DataFrame:
    """Rows (prefix, b, e) whose window is given and empty at both ends; missing ones don't count."""
    return params.where((F.size("b") == 0) & (F.size("e") == 0))


def counters(heaps: DataFrame, complete: Column, late: Column) -> list[Column]:
    """Counters of an ingest, for ``observe`` on a stream or ``agg`` on a table."""
    return [F.count(F.lit(1)).alias("heaps"), F.count_if(~complete).alias("incomplete"), F.count_if(complete & late).alias("too_old"), F.count_if(complete & ~late).alias("accepted")]

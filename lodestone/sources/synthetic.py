"""Synthetic visibilities with known gains and delays, generated by Spark.

``vis = S(freq) exp(2 pi i (K1 - K2) freq) G1 conj(G2)``, with the polarisation index v=0, h=1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import cplx

POLS = ("v", "h")


@dataclass
class Truth:
    """Gains and delays by [pol][antenna]."""

    n_ants: int = 4
    seed: int = 1
    delay: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        rng = np.random.RandomState(self.seed)
        self.delay = rng.uniform(-50e-12, 50e-12, (2, self.n_ants))
        self.gain = rng.uniform(2, 4, (2, self.n_ants)) + 1j * rng.uniform(-0.1, 0.1, (2, self.n_ants))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(a, POLS[p], float(self.gain[p, a].real), float(self.gain[p, a].imag), float(self.delay[p, a])) for p in range(2) for a in range(self.n_ants)]
        return spark.createDataFrame(rows, "ant int, pol string, re double, im double, delay double")


def channel_table(spark: SparkSession, n: int, bandwidth: float, centre: float) -> DataFrame:
    """(chan, freq_hz): centre + (bandwidth / n)(i - n // 2)."""
    return spark.range(n).select(F.col("id").cast("int").alias("chan"), (F.lit(centre) + F.lit(bandwidth / n) * (F.col("id") - n // 2)).alias("freq_hz"))


def corrprods(n_ants: int) -> list[tuple[int, int, str, str]]:
    """(ant1, ant2, pol1, pol2): autocorrelations first, each as hh, vv, hv, vh."""
    pairs = [(a, a) for a in range(n_ants)] + [(a, b) for a in range(n_ants) for b in range(a + 1, n_ants)]
    return [(a, b, p, q) for a, b in pairs for p, q in (("h", "h"), ("v", "v"), ("h", "v"), ("v", "h"))]


def visibilities(spark: SparkSession, truth: Truth, n_chans: int, n_dumps: int, bandwidth: float = 856e6, centre: float = 1284e6, int_time: float = 4.0, first: float = 100.0, corrupt: tuple[int, ...] = (), noise: float = 0.0) -> DataFrame:
    """Rows: dump, ts, chan, freq_hz, ant1, ant2, pol1, pol2, pol, re, im, flags, weight."""
    gains = truth.table(spark)
    prods = spark.createDataFrame(corrprods(truth.n_ants), "ant1 int, ant2 int, pol1 string, pol2 string")
    one = gains.select(F.col("ant").alias("ant1"), F.col("pol").alias("pol1"), F.col("re").alias("r1"), F.col("im").alias("i1"), F.col("delay").alias("k1"))
    two = gains.select(F.col("ant").alias("ant2"), F.col("pol").alias("pol2"), F.col("re").alias("r2"), F.col("im").alias("i2"), F.col("delay").alias("k2"))
    prods = prods.join(one, ["ant1", "pol1"]).join(two, ["ant2", "pol2"])
    grid = spark.range(n_dumps).withColumnRenamed("id", "dump").crossJoin(F.broadcast(channel_table(spark, n_chans, bandwidth, centre)))
    rows = grid.crossJoin(F.broadcast(prods))
    g = cplx.mul((F.col("r1"), F.col("i1")), cplx.conj((F.col("r2"), F.col("i2"))))
    v = cplx.mul(g, cplx.delay_phasor(F.col("k1") - F.col("k2"), F.col("freq_hz")))
    hit = F.when(F.col("dump").isin(*corrupt), 1e9).otherwise(0.0) if corrupt else F.lit(0.0)
    return rows.select(
        "dump", (F.lit(first) + F.col("dump") * int_time).alias("ts"), "chan", "freq_hz", "ant1", "ant2", "pol1", "pol2", F.concat("pol1", "pol2").alias("pol"),
        (v[0] + F.randn(1) * noise).alias("re"), (v[1] + hit + F.randn(2) * noise).alias("im"), F.lit(0).alias("flags"), F.lit(1.0).alias("weight"),
    )

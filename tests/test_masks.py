"""Static masks against every range, one by one."""

from __future__ import annotations

import math
import random

from lodestone.operators import masks


def _plain(channels, baselines, ranges, width):
    out = set()
    for c, f in channels:
        for a, b, length in baselines:
            if any(f + width / 2 >= lo and f - width / 2 <= hi and (most is None or length <= most) for lo, hi, most in ranges if lo is not None and hi is not None):
                out.add((c, a, b))
    return out


def test_mask_equals_every_range(spark):
    rng = random.Random(3)
    channels = [(k, 856e6 + 1e5 * k) for k in range(300)]
    baselines = [(0, 1, 20.0), (0, 2, 300.0), (1, 2, 5000.0)]
    ranges = [(lo := 856e6 + 1e5 * rng.uniform(-5, 310), lo + rng.choice([0, 1e3, 5e4, 1e6, 4e6]), rng.choice([None, 100.0, 1000.0])) for _ in range(25)]
    ranges += [(None, 1e9, None), (1e9, None, None), (9e8, 8e8, None), (856e6, 856e6, 10.0), (0.0, 1e5, None), (1e3, 860e6, 25.0)]
    frames = (spark.createDataFrame(channels, "chan int, freq_hz double"), spark.createDataFrame(baselines, "ant1 int, ant2 int, length double"), spark.createDataFrame(ranges, "lo double, hi double, max_length double"))
    out = masks.baseline_mask(*frames, 1e5)
    assert out.count() == 900
    got = {(r.chan, r.ant1, r.ant2) for r in out.where("masked").collect()}
    assert got == _plain(channels, baselines, ranges, 1e5) and 0 < len(got) < 900
    vis = spark.createDataFrame([(c, a, b, 2) for c, _ in channels for a, b, _ in baselines] + [(5, 7, 8, 0)], "chan int, ant1 int, ant2 int, flags int")
    flagged = masks.flag_masked(vis, *frames, 1e5, 64)
    assert {(r.chan, r.ant1, r.ant2) for r in flagged.where("flags = 66").collect()} == got and flagged.count() == 901


def test_mask_without_ranges(spark):
    channels, baselines = spark.createDataFrame([(0, 1e9)], "chan int, freq_hz double"), spark.createDataFrame([(0, 1, math.nan)], "ant1 int, ant2 int, length double")
    none = spark.createDataFrame([], "lo double, hi double, max_length double")
    assert [r.masked for r in masks.baseline_mask(channels, baselines, none, 1e5).collect()] == [False]


def test_no_nested_loop_over_ranges(spark):
    channels, ranges = spark.createDataFrame([(0, 1e9)], "chan int, freq_hz double"), spark.createDataFrame([(1.0, 2.0, 3.0)], "lo double, hi double, max_length double")
    plan = masks.masked_lengths(channels, ranges, 1e5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

"""Sound against known levels and plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from turnloom.operators import audio as A


def test_known_loudness():
    t = np.arange(48_000 * 4) / 48_000
    # a full-scale sine of 997 Hz in one channel is -3.01
    assert abs(A.integrated_loudness(np.sin(2 * np.pi * 997 * t), 48_000) + 3.01) < 0.05
    half = A.integrated_loudness(0.5 * np.sin(2 * np.pi * 997 * t), 48_000)
    assert abs(half + 3.01 + 20 * math.log10(2)) < 0.05
    # silence beside it is gated out
    both = np.concatenate([np.sin(2 * np.pi * 997 * t), np.zeros(len(t))])
    assert abs(A.integrated_loudness(both, 48_000) + 3.01) < 0.3
    assert A.integrated_loudness(np.zeros(48_000), 48_000) is None and A.integrated_loudness(np.ones(10), 48_000) is None


def test_filter_is_the_recursion():
    rng = np.random.default_rng(1)
    x, rate = rng.normal(size=400), 8000.0
    y = x
    for b, a in (A._shelf(rate), A._high_pass(rate)):
        out = np.zeros(len(y))
        for i in range(len(y)):
            out[i] = (sum(b[k] * y[i - k] for k in range(3) if i >= k) - sum(a[k] * out[i - k] for k in (1, 2) if i >= k)) / a[0]
        y = out
    assert np.allclose(A.weighted(x, rate), y, atol=1e-3)


def test_columns(spark):
    rnd = random.Random(1)
    rows = [[], None, [0.0, 0.01], [0.5], [0.0, 0.2, 0.0, -0.9, 0.05], [rnd.uniform(-1, 1) for _ in range(50)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<double>").orderBy("i")
    got = [r[0] for r in df.select(A.trimmed(F.col("x"), 0.1)).collect()]
    assert got[:5] == [[], None, [], [0.5], [0.2, 0.0, -0.9]]
    assert df.where("i = 4").select(A.trimmed(F.col("x"), 0.1, 1)).first()[0] == rows[4]
    up = [r[0] for r in df.select(A.resampled(F.col("x"), 1, 2)).collect()]
    assert up[0] == [] and up[1] is None and up[3] == [0.5, 0.5] and len(up[5]) == 100 and up[5][::2] == rows[5]
    assert np.allclose(up[5][1:-1:2], (np.array(rows[5][:-1]) + rows[5][1:]) / 2)
    assert [r[0] for r in df.select(A.loudness(F.col("x"), 8000.0)).collect()] == [None] * 6
    v = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [None if r[0] is None else round(r[0], 6) for r in v.select(A.cosine(F.col("a"), F.col("b"))).collect()] == [0.707107, None, None]
    assert [r[0] for r in spark.createDataFrame([(-23.0,), (-29.0206,), (None,)], "l double").select(F.round(A.gain_to(F.col("l")), 3)).collect()] == [1.0, 2.0, 1.0]

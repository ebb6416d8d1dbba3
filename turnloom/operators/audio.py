"""Sound as arrays of samples: loudness, trimming and resampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The two filters of the loudness measure (gain in dB, Q, frequency), its offset, gates, block and step.
SHELF, PASS_ = (4.0, 1 / np.sqrt(2), 1500.0), (0.0, 0.5, 38.0)
OFFSET, ABSOLUTE, RELATIVE, BLOCK_SEC, STEP = -0.691, -70.0, -10.0, 0.4, 0.25


def _shelf(rate: float) -> tuple[np.ndarray, np.ndarray]:
    gain, q, frequency = SHELF
    a = 10 ** (gain / 40)
    w = 2 * np.pi * frequency / rate
    alpha, c, r = np.sin(w) / (2 * q), np.cos(w), np.sqrt(a)
    b = np.array([a * ((a + 1) + (a - 1) * c + 2 * r * alpha), -2 * a * ((a - 1) + (a + 1) * c), a * ((a + 1) + (a - 1) * c - 2 * r * alpha)])
    return b, np.array([(a + 1) - (a - 1) * c + 2 * r * alpha, 2 * ((a - 1) - (a + 1) * c), (a + 1) - (a - 1) * c - 2 * r * alpha])


def _high_pass(rate: float) -> tuple[np.ndarray, np.ndarray]:
    _, q, frequency = PASS_
    w = 2 * np.pi * frequency / rate
    alpha, c = np.sin(w) / (2 * q), np.cos(w)
    return np.array([(1 + c) / 2, -(1 + c), (1 + c) / 2]), np.array([1 + alpha, -2 * c, 1 - alpha])


def weighted(x: np.ndarray, rate: float) -> np.ndarray:
    """Samples after both filters, by their frequency response; zeros behind the samples take up what rings on."""
    n = 1 << int(len(x) + rate).bit_length()
    z = np.exp(-1j * 2 * np.pi * np.arange(n // 2 + 1) / n)
    response = 1.0
    for b, a in (_shelf(rate), _high_pass(rate)):
        response = response * (b[0] + b[1] * z + b[2] * z * z) / (a[0] + a[1] * z + a[2] * z * z)
    return np.fft.irfft(np.fft.rfft(x, n) * response, n)[: len(x)]


def integrated_loudness(x: np.ndarray, rate: float) -> float | None:
    """Integrated loudness in LUFS of one channel: the mean power of the blocks that pass both gates; null if none does or there is no whole block."""
    size, step = int(BLOCK_SEC * rate), int(BLOCK_SEC * STEP * rate)
    if len(x) < size or not size:
        return None
    power = np.concatenate([[0.0], np.cumsum(weighted(np.asarray(x, dtype=np.float64), rate) ** 2)])
    starts = np.arange(0, len(x) - size + 1, step)
    means = (power[starts + size] - power[starts]) / size
    with np.errstate(divide="ignore"):
        loud = OFFSET + 10 * np.log10(np.maximum(means, 0))
    kept = means[loud > ABSOLUTE]
    if not len(kept):
        return None
    gate = OFFSET + 10 * np.log10(kept.mean()) + RELATIVE
    kept = means[loud > max(gate, ABSOLUTE)]
    return float(OFFSET + 10 * np.log10(kept.mean())) if len(kept) else None


def loudness(samples: Column, rate: float) -> Column:
    """Integrated loudness of an array of samples, in Arrow batches."""

    @F.pandas_udf("double")
    def lufs(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else integrated_loudness(np.asarray(x, dtype=np.float64), rate) for x in s], dtype="float64")

    return lufs(samples)


def gain_to(loud: Column, target: float = -23.0) -> Column:
    """The factor that brings a loudness to a target; 1 where there is no loudness."""
    return F.coalesce(F.pow(F.lit(10.0), (F.lit(target) - loud) / 20), F.lit(1.0))


def trimmed(samples: Column, threshold: float, keep: int = 0) -> Column:
    """Samples without the quiet ones at both ends, but for ``keep`` of them; the empty array if all are quiet."""
    loud = F.filter(F.transform(samples, lambda x, i: F.when(F.abs(x) > threshold, i)), lambda i: i.isNotNull())
    first = F.greatest(F.array_min(loud) - keep, F.lit(0))
    last = F.least(F.array_max(loud) + keep, F.size(samples) - 1)
    return F.when(F.size(loud) > 0, F.slice(samples, first + 1, last - first + 1)).otherwise(F.slice(samples, 1, 0))


def resampled(samples: Column, rate: int, to: int) -> Column:
    """Samples at another rate by linear interpolation; null stays null."""
    n = F.floor(F.size(samples) * to / rate).cast("int")

    def at(k: Column) -> Column:
        place = k * (rate / to)
        i = F.floor(place).cast("int")
        a = F.get(samples, i)
        return a + (F.coalesce(F.get(samples, i + 1), a) - a) * (place - i)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.slice(samples, 1, 0))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two vectors; null where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))

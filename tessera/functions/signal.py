"""Measures of sample arrays, as numpy under Arrow, and edits, as native array functions. Samples are doubles in [-1, 1]."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .rx import let

FLOOR = 1e-9
SILENT_DB, CLIPPED = -40.0, 0.999


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _decibels(v: Column) -> Column:
    return F.lit(20.0) * F.log10(F.greatest(v, F.lit(FLOOR)))


def peak(s: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(s, lambda x: F.abs(x))), F.lit(0.0))


def frame_length(rate: Column, seconds: float = 0.02) -> Column:
    return F.greatest((F.lit(seconds) * rate).cast("int"), F.lit(1))


def _levels(x, frame: int):
    """The level in dB of each whole frame; none for a signal shorter than one."""
    import numpy as np

    n = len(x) // frame
    return 20 * np.log10(np.maximum(np.sqrt((x[: n * frame].reshape(n, frame) ** 2).mean(axis=1)), FLOOR)) if n else np.zeros(0)


def _samples(x):
    """An array as Arrow hands it over; none is empty, and so is a null in it silence."""
    import numpy as np

    return np.zeros(0) if x is None else np.nan_to_num(np.asarray(x, np.float64), nan=0.0)


def _measures(samples: pd.Series, frame: pd.Series) -> pd.DataFrame:
    import numpy as np

    rows = []
    for s, f in zip(samples, frame, strict=True):
        x = _samples(s)
        levels = _levels(x, max(1, int(f)))
        rows.append((len(x) if s is not None else None, np.abs(x).max(initial=0.0), np.sqrt((x * x).mean()) if len(x) else 0.0, (np.abs(x) >= CLIPPED).mean() if len(x) else 1.0, (levels < SILENT_DB).mean() if len(levels) else 1.0))
    return pd.DataFrame(rows, columns=["n", "peak", "rms", "clipping", "silence"])


def metrics(samples: Column, rate: Column, frame: Column | None = None) -> Column:
    """struct of duration, peak_db, rms_db, clipping_ratio and silence_ratio, rounded as the grades read them. A clip's samples
    are worked on as one numpy array; no samples are silence and clipped."""
    frame = frame_length(rate) if frame is None else frame
    m = F.pandas_udf(_measures, "n bigint, peak double, rms double, clipping double, silence double")(samples.cast("array<double>"), F.coalesce(frame, F.lit(1)))
    return F.struct(
        F.round(m["n"] / rate, 3).alias("duration"), F.round(_decibels(m["peak"]), 2).alias("peak_db"), F.round(_decibels(m["rms"]), 2).alias("rms_db"),
        F.round(m["clipping"], 4).alias("clipping_ratio"), F.round(m["silence"], 4).alias("silence_ratio"),
    )


def trim_bounds(samples: Column, frame: Column, pad: Column, threshold: float = SILENT_DB) -> Column:
    """struct of first (inclusive) and last (exclusive): what lies between voiced frames, padded; all if none is."""

    def run(samples: pd.Series, frame: pd.Series, pad: pd.Series) -> pd.DataFrame:
        import numpy as np

        rows = []
        for s, f, p in zip(samples, frame, pad, strict=True):
            x = _samples(s)
            voiced = np.flatnonzero(_levels(x, max(1, int(f))) >= threshold)
            rows.append((max(0, voiced[0] * f - p), min(len(x), (voiced[-1] + 1) * f + p)) if len(voiced) else (0, len(x)))
        return pd.DataFrame(rows, columns=["first", "last"])

    return F.pandas_udf(run, "first int, last int")(samples.cast("array<double>"), frame, pad)


def trim(samples: Column, frame: Column, pad: Column) -> Column:
    bounds = trim_bounds(samples, frame, pad)
    return F.slice(samples, bounds["first"] + 1, bounds["last"] - bounds["first"])


def cap_peak(samples: Column, most: float = 0.98) -> Column:
    return let(peak(samples), lambda p: F.when(p > most, F.transform(samples, lambda x: x * (F.lit(most) / p))).otherwise(samples))


def raise_peak(samples: Column, to: float = 0.7) -> Column:
    """The gain for clips that a loudness meter cannot judge."""
    return let(peak(samples), lambda p: F.when(p > 0, F.transform(samples, lambda x: x * (F.lit(to) / p))).otherwise(samples))


def _loudness(x, rate: float) -> float:
    """Integrated loudness in LUFS by ITU-R BS.1770: K-weighting, blocks of 400 ms, an absolute and a relative gate."""
    import numpy as np

    x = np.asarray(x, np.float64)
    block, hop = int(0.4 * rate), int(0.1 * rate)
    if block < 1 or len(x) < block:
        return float("nan")
    # The analogue prototypes of the two filters of the recommendation.
    shelf_hz, shelf_db, shelf_q, pass_hz, pass_q = 1681.974450955533, 3.999843853973347, 0.7071752369554196, 38.13547087602444, 0.5003270373238773
    n = len(x) + int(rate)  # a second for the filters to die away
    z = np.exp(-2j * np.pi * np.fft.rfftfreq(n))

    def response(hz: float, q: float, above: float, middle: float, below: float):
        k = np.tan(np.pi * hz / rate)
        top = (above + middle * k / q + below * k * k) + 2 * (below * k * k - above) * z + (above - middle * k / q + below * k * k) * z * z
        return top / ((1 + k / q + k * k) + 2 * (k * k - 1) * z + (1 - k / q + k * k) * z * z)

    gain = 10 ** (shelf_db / 20)
    k = np.tan(np.pi * pass_hz / rate)
    weight = response(shelf_hz, shelf_q, gain, gain**0.4996667741545416, 1.0) * response(pass_hz, pass_q, 1.0, 0.0, 0.0) * (1 + k / pass_q + k * k)
    y = np.fft.irfft(np.fft.rfft(x, n) * weight, n)[: len(x)]
    power = np.concatenate([[0.0], np.cumsum(y * y)])
    starts = np.arange(0, len(x) - block + 1, hop)
    mean = (power[starts + block] - power[starts]) / block
    level = -0.691 + 10 * np.log10(np.maximum(mean, 1e-300))
    loud = mean[level > -70]
    if not len(loud):
        return float("-inf")
    gate = -0.691 + 10 * np.log10(loud.mean()) - 10
    return float(-0.691 + 10 * np.log10(mean[(level > -70) & (level > gate)].mean()))


def _meter(samples: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or r is None else _loudness(x, r) for x, r in zip(samples, rate, strict=True)], dtype="float64")


def loudness(samples: Column, rate: Column) -> Column:
    """Integrated loudness in LUFS; not a number for clips under a block, minus infinity for silence."""
    return F.pandas_udf(_meter, "double")(samples, rate)


def to_loudness(samples: Column, lufs: Column, target: float = -20.0, most: float = 0.98) -> Column:
    """samples at the target loudness, their peak capped; by raise_peak where the loudness is not finite."""
    finite = lufs.isNotNull() & ~F.isnan(lufs) & (F.abs(lufs) < float("inf"))
    scaled = F.transform(samples, lambda x: x * F.pow(F.lit(10.0), (F.lit(target) - lufs) / 20))
    return cap_peak(F.when(finite, scaled).otherwise(raise_peak(samples)), most)


def leveled(x, rate: float, target: float = -20.0, most: float = 0.98, raised: float = 0.7):
    """to_loudness() of one clip, as numpy: for stages that have the samples in Python anyway."""
    import numpy as np

    x = np.asarray(x, np.float64)
    top, lufs = np.abs(x).max(initial=0.0), _loudness(x, rate)
    x = x * 10 ** ((target - lufs) / 20) if np.isfinite(lufs) else x * (raised / top) if top else x
    top = np.abs(x).max(initial=0.0)
    return x * (most / top) if top > most else x


def downmix(frames: Column) -> Column:
    """array<array<double>> (frames of channels) to the mean of the channels."""
    return F.transform(frames, lambda c: _sum(c) / F.size(c))


def speech_ratio(spans: Column, length: Column) -> Column:
    """The share of a signal that spans (struct<start, end>) cover."""
    return F.aggregate(F.transform(spans, lambda x: x["end"] - x["start"]), F.lit(0).cast("long"), lambda a, x: a + x) / length


def vad_slice(samples: Column, spans: Column, scale: Column) -> Column:
    """From the first span's start to the last one's end, both scaled and cut to whole samples."""
    first = (F.get(spans, F.lit(0))["start"] * scale).cast("int")
    last = (F.element_at(spans, -1)["end"] * scale).cast("int")
    return F.slice(samples, first + 1, F.greatest(F.lit(0), last - first))


def with_pauses(pieces: Column, pause: Column) -> Column:
    """array<array<double>> joined with ``pause`` zeros between pieces and none at the end."""
    quiet = F.array_repeat(F.lit(0.0), pause.cast("int"))
    return F.flatten(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(quiet, p))))

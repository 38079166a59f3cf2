"""Features of waves of any length: a wave is rows of samples, and no task holds more than a run or a strip of it.

Rows have the wave's keys, `start` (the place of the row's first sample), `length` (samples of the whole wave) and
`samples`; placed() adds the two numbers. Rows of a wave cover it without gaps, in whatever pieces.

Framed features (pitch, cepstrum) cut a wave into runs of frames, which overlap by a frame; results of runs are added up,
and medians are selected without gathering a wave's frames. The spectrum of a whole wave is one transform of as many bins
as the wave has, whatever its length: a chirp turns it into a convolution whose length is a power of two, the samples of
which form a matrix. Columns are transformed in strips of columns, rows in strips of rows, and tiles of the matrix move
in between: three shuffles, each task with at most `cells` numbers or one line of the matrix. Waves have fewer than 2^31 samples.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import signal as G
from .quantiles import group_stats
from .rows import with_group

#: Numbers of a matrix that one task transforms at a time.
CELLS = 1 << 19
#: Frames of a run: at 10 ms each, some 80 seconds.
FRAMES = 8192


def placed(df: DataFrame, keys: list[str], coarse: str, fine: str, samples: str = "samples") -> DataFrame:
    """df with `start` and `length`, its rows laid end to end by (coarse, fine); rows are summed up inside (key, coarse) only. A null row has no samples."""
    sized = df.withColumn("_size", F.coalesce(F.size(samples), F.lit(0)).cast("long"))
    sums = sized.groupBy(*keys, coarse).agg(F.sum("_size").alias("_sum"))
    upto = W.partitionBy(*keys).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*keys, coarse, F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_base"), F.sum("_sum").over(W.partitionBy(*keys)).alias("length"))
    inside = F.coalesce(F.sum("_size").over(W.partitionBy(*keys, coarse).orderBy(fine).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return with_group(sized, base, [*keys, coarse]).withColumn("start", F.col("_base") + inside).drop("_base", "_size")


def _fields(df: DataFrame, keys: list[str], more: str) -> StructType:
    return StructType([df.schema[k] for k in keys] + StructType.fromDDL(more).fields)


def _pieces(waves: DataFrame, keys: list[str], part: str, first: Column, last: Column, low: Column, high: Column, also: list[str] = ()) -> DataFrame:
    """keys, part, at, piece: of each row what lies in the parts first to last, each the samples from low up to high (columns over part)."""
    own = waves.where(F.size("samples") > 0)
    each = own.select("*", F.explode(F.sequence(first, last)).alias(part)).withColumn("at", F.greatest(F.col("start"), low))
    end = F.least(F.col("start") + F.size("samples"), high)
    each = each.select(*keys, part, *also, "at", F.slice("samples", (F.col("at") - F.col("start") + 1).cast("int"), F.greatest(end - F.col("at"), F.lit(0)).cast("int")).alias("piece"))
    return each.where(F.size("piece") > 0)


def _laid(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The samples of all pieces, and their places in the wave."""
    sizes = pdf["piece"].map(len).to_numpy()
    total = int(sizes.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.concatenate([np.asarray(p, np.float64) for p in pdf["piece"]]), np.repeat(pdf["at"].to_numpy(np.int64), sizes) + inside


# framed features
def run_features(waves: DataFrame, keys: list[str], rate: int, frames: int = FRAMES) -> DataFrame:
    """keys, f0 array<double>, heard long, cepstrum array<double>: of each run the pitches of its voiced frames, its frames that aren't silent and the sum of their cepstra."""
    hop, widest = max(1, int(0.010 * rate)), int(0.04 * rate)
    span = frames * hop
    reach = span - hop + widest + 1  # a frame counts where a sample follows it
    run = F.col("_run")
    first = F.greatest(F.lit(0), F.floor((F.col("start") - reach) / span) + 1).cast("long")
    last = F.floor((F.col("start") + F.size("samples") - 1) / span).cast("long")
    cut = _pieces(waves, keys, "_run", first, last, run * span, run * span + reach)

    def of_run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, at = _laid(pdf)
        x = x[np.argsort(at, kind="stable")]
        cepstra = G.loud_cepstra(x[: span - hop + int(0.025 * rate) + 1], rate)
        out = pdf[keys].iloc[:1].copy()
        out["f0"], out["heard"], out["cepstrum"] = [G.pitch_track(x, rate).tolist()], len(cepstra), [cepstra.sum(0).tolist()]
        return out

    return cut.groupBy(*keys, "_run").applyInPandas(of_run, _fields(waves, keys, "f0 array<double>, heard long, cepstrum array<double>"))


def descriptors(waves: DataFrame, keys: list[str], rate: int, frames: int = FRAMES, kept: int = 13) -> DataFrame:
    """keys and the fields of signal.DESCRIPTORS: what signal.descriptors() says of a wave in one row. Waves without samples have level -200 and zeros."""
    squares = F.aggregate(F.coalesce("samples", F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    level = waves.groupBy(*keys).agg(F.max("length").alias("_n"), F.sum(squares).alias("_squares"))
    runs = run_features(waves, keys, rate, frames)
    sums = runs.groupBy(*keys).agg(F.sum("heard").alias("_heard"), *[F.sum(F.col("cepstrum")[i]).alias(f"_c{i}") for i in range(kept)])
    f0 = runs.select(*keys, F.explode("f0").alias("f0"))
    pitch = group_stats(f0, keys, {"_median": (F.col("f0"), 0.5)}, [F.stddev_pop(12 * F.log2("f0")).alias("_spread"), F.count(F.lit(1)).alias("_voiced")])
    made = _beside(_beside(level, sums, keys), pitch, keys)
    hops = F.greatest(F.lit(1), F.floor(F.col("_n") / max(1, int(0.010 * rate))))
    return made.select(
        *keys,
        (F.col("_n") / float(rate)).alias("seconds"),
        F.coalesce("_median", F.lit(0.0)).alias("f0_median"),
        F.coalesce("_spread", F.lit(0.0)).alias("f0_spread_st"),
        (20 * F.log10(F.sqrt(F.when(F.col("_n") > 0, F.col("_squares") / F.col("_n")).otherwise(0.0)) + 1e-10)).alias("rms_db"),
        (F.coalesce("_voiced", F.lit(0)) / hops).alias("voiced"),
        F.array(*[F.when(F.col("_heard") > 0, F.col(f"_c{i}") / F.col("_heard")).otherwise(0.0) for i in range(kept)]).alias("mfcc"),
    )


def _beside(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of other's row of the same keys, or nulls; null keys are keys."""
    named = other.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *[c for c in other.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    return df.join(named, on, "left").drop(*[f"_g{i}" for i in range(len(keys))])


# spectra
def _shape(n: int, cells: int) -> tuple[int, int, int]:
    """Rows, columns and strips of the matrix of a wave of n samples. _plan() says the same in columns."""
    bits = max(1, (2 * n - 2).bit_length())
    rows = bits // 2
    return 1 << rows, 1 << (bits - rows), 1 << max(0, min(rows, bits - (cells.bit_length() - 1)))


def _plan(length: Column, cells: int) -> tuple[Column, Column]:
    """Columns of a strip, and strips."""
    bits = F.greatest(F.lit(1), F.when(length > 1, F.length(F.bin(2 * length - 2))).otherwise(1))
    rows = F.floor(bits / 2)
    strips = F.greatest(F.lit(0), F.least(rows, bits - (cells.bit_length() - 1)))
    power = lambda e: F.pow(F.lit(2.0), e).cast("long")
    return power(bits - rows - strips), power(strips)


def _turn(t: np.ndarray, n: int) -> np.ndarray:
    """exp(i pi t^2 / n), with the square taken in whole numbers."""
    return np.exp(1j * np.pi * ((t * t) % (2 * n)) / n)


def _taper(t: np.ndarray, n: int) -> np.ndarray:
    """The symmetric Hann window of n samples at t."""
    return np.ones(len(t)) if n == 1 else 0.5 + 0.5 * np.cos(np.pi * (1 - n + 2 * t) / (n - 1))


def _tiles(pdf: pd.DataFrame, keys: list[str], strips: int, blocks: list[tuple[bytes, ...]], names: list[str]) -> pd.DataFrame:
    """A row for each strip on the other axis, with its tile of this one."""
    out = pdf[[*keys, "length"]].iloc[[0] * strips].reset_index(drop=True)
    out["_to"], out["_from"] = np.arange(strips), int(pdf["_strip"].iloc[0])
    for i, name in enumerate(names):
        out[name] = [b[i] for b in blocks]
    return out


def _spectra(waves: DataFrame, keys: list[str], finish: Callable[[np.ndarray, np.ndarray, int], pd.DataFrame], fields: str, cells: int) -> DataFrame:
    """keys and what finish() makes of (bins, power, samples of the wave) in each strip: bins are a matrix, every row of which runs on by one."""
    if cells < 64:
        raise ValueError("a strip has at least 64 cells")
    width, strips = _plan(F.col("length"), cells)
    sized = waves.withColumn("_width", width).withColumn("_strips", strips)
    part = F.col("_part")
    end = F.col("start") + F.size("samples") - 1
    whole = lambda c: F.floor(c / F.col("_width")).cast("long")
    cut = _pieces(sized, keys, "_part", whole(F.col("start")), whole(end), part * F.col("_width"), (part + 1) * F.col("_width"), ["length", "_strips"])
    cut = cut.withColumn("_strip", part % F.col("_strips"))
    tile = "length long, _to long, _from long, a binary"

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        n, strip = int(pdf["length"].iloc[0]), int(pdf["_strip"].iloc[0])
        rows, cols, strips = _shape(n, cells)
        w = cols // strips
        at = strip * w + np.arange(w)
        x, t = _laid(pdf)
        wave = np.zeros((rows, w), np.complex128)
        wave[t // cols, t % cols - strip * w] = x * _taper(t, n) / _turn(t, n)
        away = np.arange(rows)[:, None] * cols + at
        away = np.minimum(away, rows * cols - away)
        chirp = np.where(away < n, _turn(np.minimum(away, n), n), 0)
        twist = np.exp(-2j * np.pi * (np.arange(rows)[:, None] * at) / (rows * cols))
        parts = [np.split(np.fft.fft(m, axis=0) * twist, strips) for m in (wave, chirp)]
        return _tiles(pdf, keys, strips, [(a.tobytes(), b.tobytes()) for a, b in zip(*parts, strict=True)], ["a", "b"])

    def lines(pdf: pd.DataFrame) -> pd.DataFrame:
        n, strip = int(pdf["length"].iloc[0]), int(pdf["_strip"].iloc[0])
        rows, cols, strips = _shape(n, cells)
        pdf = pdf.sort_values("_from")
        h = rows // strips
        wave, chirp = (np.fft.fft(np.hstack([np.frombuffer(v, np.complex128).reshape(h, -1) for v in pdf[c]]), axis=1) for c in ("a", "b"))
        at = strip * h + np.arange(h)[:, None]
        back = np.fft.fft(np.conj(wave * chirp), axis=1) * np.exp(-2j * np.pi * (at * np.arange(cols)) / (rows * cols))
        return _tiles(pdf, keys, strips, [(np.ascontiguousarray(a).tobytes(),) for a in np.split(back, strips, axis=1)], ["a"])

    def power(pdf: pd.DataFrame) -> pd.DataFrame:
        n, strip = int(pdf["length"].iloc[0]), int(pdf["_strip"].iloc[0])
        rows, cols, strips = _shape(n, cells)
        pdf = pdf.sort_values("_from")
        w = cols // strips
        made = np.fft.fft(np.vstack([np.frombuffer(v, np.complex128).reshape(-1, w) for v in pdf["a"]]), axis=0) / (rows * cols)
        bins = np.arange(rows)[:, None] * cols + strip * w + np.arange(w)
        out = finish(bins, np.abs(made) ** 2, n)
        for i, k in enumerate(keys):
            out.insert(i, k, [pdf[k].iloc[0]] * len(out))
        return out

    by_columns = cut.groupBy(*keys, "_strip").applyInPandas(columns, _fields(waves, keys, tile + ", b binary")).withColumnRenamed("_to", "_strip")
    by_lines = by_columns.groupBy(*keys, "_strip").applyInPandas(lines, _fields(waves, keys, tile)).withColumnRenamed("_to", "_strip")
    return by_lines.groupBy(*keys, "_strip").applyInPandas(power, _fields(waves, keys, fields))


def power_spectrum(waves: DataFrame, keys: list[str], cells: int = CELLS) -> DataFrame:
    """keys, first long, power array<double>: the power of the bins from first on; rows cover all bins of a wave once, as signal.power_spectrum() has them."""

    def finish(bins: np.ndarray, power: np.ndarray, n: int) -> pd.DataFrame:
        most = n // 2 + 1
        rows = [(int(b[0]), p[: most - int(b[0])].tolist()) for b, p in zip(bins, power, strict=True) if b[0] < most]
        return pd.DataFrame(rows, columns=["first", "power"])

    return _spectra(waves, keys, finish, "first long, power array<double>", cells)


def spectrum_features(waves: DataFrame, keys: list[str], rate: float, centres: tuple = (), low_edge: float = 150.0, cells: int = CELLS) -> DataFrame:
    """keys, low_share, centroid_narrow, centroid_voice, centroid_wide, shares: what signal.spectrum_features() says of a wave in one row.

    Each strip sums the energy of its bins by bands; strips are added up. Waves without samples or energy have zeros.
    """
    bands = [*G.CENTROID_BANDS.values()]

    def finish(bins: np.ndarray, power: np.ndarray, n: int) -> pd.DataFrame:
        real = bins < n // 2 + 1
        p, f = power[real], bins[real] * (1.0 / (n * (1 / rate)))
        inside = lambda low, high: (f > low) & (f < high)
        sums = [p[inside(*G.VOICE_BAND)].sum(), p[inside(G.VOICE_BAND[0], low_edge)].sum()]
        for band in bands:
            sums += [p[inside(*band)].sum(), (p * f)[inside(*band)].sum()]
        sums += [p[(f >= 0.6 * c) & (f < 1.4 * c)].sum() for c in centres]
        return pd.DataFrame({"sums": [list(map(float, sums))]})

    many = 2 + 2 * len(bands) + len(centres)
    each = _spectra(waves, keys, finish, "sums array<double>", cells)
    total = each.groupBy(*keys).agg(*[F.sum(F.col("sums")[i]).alias(f"_s{i}") for i in range(many)])
    over = lambda a, b: F.when(F.col(f"_s{b}") > 0, F.col(f"_s{a}") / F.col(f"_s{b}")).otherwise(0.0)
    names = [f"centroid_{c}" for c in G.CENTROID_BANDS]
    shares = F.array(*[over(2 + 2 * len(bands) + i, 0) for i in range(len(centres))]).cast("array<double>")
    made = _beside(waves.groupBy(*keys).agg(F.max("length").alias("_n")), total, keys)
    return made.select(*keys, over(1, 0).alias("low_share"), *[over(3 + 2 * i, 2 + 2 * i).alias(c) for i, c in enumerate(names)], shares.alias("shares"))

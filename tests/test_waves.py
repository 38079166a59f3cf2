"""Waves in many rows against the same waves in one."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocktake.functions import signal as G
from stocktake.operators import waves as O

RATE = 800


def in_rows(spark, waves, seed=5):
    """Each wave cut into rows of uneven sizes, empty ones too."""
    draw, rows = np.random.default_rng(seed), []
    for key, x in waves.items():
        cuts = np.sort(draw.integers(0, len(x) + 1, 9))
        for i, piece in enumerate(np.split(x, cuts)):
            rows.append((key, i // 3, i, piece.tolist()))
    return spark.createDataFrame(rows, "wave string, coarse int, fine int, samples array<double>")


def voice(n, seed=1):
    t = np.arange(n) / RATE
    sung = sum(a * np.sin(2 * np.pi * 90 * (k + 1) * t * (1 + 0.02 * np.sin(t))) for k, a in enumerate((0.3, 0.15)))
    return np.where((t % 3) < 2.2, sung, 0.0) + np.random.default_rng(seed).normal(0, 2e-4, n)


WAVES = {"a": voice(4000), "prime": voice(2503, 2), "short": voice(20, 3), "one": np.array([0.5]), "two": np.array([0.5, -0.25]), "silent": np.zeros(700), "none": np.zeros(0)}


@pytest.fixture(scope="module")
def rows(spark):
    return O.placed(in_rows(spark, WAVES), ["wave"], "coarse", "fine").cache()


def test_placed(rows):
    for wave, got in rows.toPandas().groupby("wave"):
        got = got.sort_values(["coarse", "fine"])
        sizes = got["samples"].map(len)
        assert (got["start"] == sizes.cumsum() - sizes).all() and (got["length"] == len(WAVES[wave])).all()


@pytest.mark.parametrize("frames", [1, 7, 100_000])
def test_descriptors(rows, frames):
    got = {r.wave: r for r in O.descriptors(rows, ["wave"], RATE, frames).collect()}
    assert set(got) == set(WAVES)
    for wave, x in WAVES.items():
        want = G.describe(x, RATE)
        for name, value in want.items():
            assert np.allclose(got[wave][name], value, rtol=1e-9, atol=1e-9), (wave, name)


@pytest.mark.parametrize("cells", [64, 1024, 1 << 19])
def test_power_spectrum(rows, cells):
    got = O.power_spectrum(rows, ["wave"], cells).toPandas()
    for wave, x in WAVES.items():
        if not len(x):
            assert not (got["wave"] == wave).any()
            continue
        mine = got[got["wave"] == wave].sort_values("first")
        sizes = mine["power"].map(len).to_numpy()
        assert (mine["first"].to_numpy() == np.cumsum(sizes) - sizes).all()
        want = G.power_spectrum(x, RATE)[0]
        assert np.allclose(np.concatenate(mine["power"].tolist()), want, rtol=1e-8, atol=1e-12 * max(want.max(), 1))
    if cells == 64:
        assert len(got[got["wave"] == "a"]) > 32


def test_spectrum_features(rows):
    centres = (90.0, 180.0)
    got = {r.wave: r for r in O.spectrum_features(rows, ["wave"], RATE, centres, cells=256).collect()}
    assert set(got) == set(WAVES)
    for wave, x in WAVES.items():
        p, f = G.power_spectrum(x, RATE)
        want = [G.band_share(p, f, 60.0, 150.0, closed=False), *(G.centroid(p, f, *b) for b in G.CENTROID_BANDS.values()), *(G.band_share(p, f, 0.6 * c, 1.4 * c) for c in centres)]
        r = got[wave]
        assert np.allclose([r.low_share, r.centroid_narrow, r.centroid_voice, r.centroid_wide, *r.shares], want, rtol=1e-8, atol=1e-10), wave


def test_null_keys_and_rows(spark):
    x = voice(600)
    df = spark.createDataFrame([(None, 0, 0, x[:300].tolist()), (None, 0, 1, None), (None, 1, 0, x[300:].tolist())], "wave string, coarse int, fine int, samples array<double>")
    waves = O.placed(df, ["wave"], "coarse", "fine")
    d, s = O.descriptors(waves, ["wave"], RATE, 5).collect(), O.spectrum_features(waves, ["wave"], RATE, cells=64).collect()
    assert len(d) == len(s) == 1 and d[0].wave is None
    assert np.allclose(d[0].mfcc, G.mean_cepstrum(x, RATE)) and np.isclose(s[0].centroid_voice, G.centroid(*G.power_spectrum(x, RATE), 60, 2000))
    none = O.placed(df.limit(0), ["wave"], "coarse", "fine")
    assert not O.descriptors(none, ["wave"], RATE).count() and not O.spectrum_features(none, ["wave"], RATE).count()


def test_an_hour(spark):
    """An hour of sound, 45 runs and 16 strips: what one row of it would say."""
    x = voice(3600 * RATE)
    step = 1 << 16
    pieces = pd.DataFrame({"wave": "hour", "start": np.arange(0, len(x), step), "length": len(x), "samples": [x[i : i + step].tolist() for i in range(0, len(x), step)]})
    waves = spark.createDataFrame(pieces).select("wave", "start", "length", F.col("samples").cast("array<float>").cast("array<double>").alias("samples"))
    kept = x.astype(np.float32).astype(np.float64)
    got, want = O.descriptors(waves, ["wave"], RATE).first(), G.describe(kept, RATE)
    assert all(np.allclose(got[name], value, rtol=1e-8, atol=1e-8) for name, value in want.items())
    s = O.spectrum_features(waves, ["wave"], RATE, (90.0,)).first()
    p, f = G.power_spectrum(kept, RATE)
    assert np.allclose([s.low_share, s.centroid_voice, s.shares[0]], [G.band_share(p, f, 60.0, 150.0, closed=False), G.centroid(p, f, 60, 2000), G.band_share(p, f, 54.0, 126.0)], rtol=1e-8)

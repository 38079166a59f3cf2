"""Functions of vectors held as array<double>; all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GUARD = 1e-10


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine with 1e-10 added to the denominator, so that zero vectors give 0."""
    return dot(a, b) / (norm(a) * norm(b) + F.lit(GUARD))


def weighted_mix(parts: Column) -> Column:
    """parts: array<struct<weight, v>>; the sum of the vectors by their share of the weights."""
    weights = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["weight"])
    start = F.transform(parts[0]["v"], lambda _: F.lit(0.0))
    add = lambda acc, p: F.zip_with(acc, p["v"], lambda x, y: x + y.cast("double") * p["weight"])
    return F.aggregate(parts, start, add, lambda s: F.transform(s, lambda x: x / weights))


def rms(x: Column) -> Column:
    return F.sqrt(total(F.transform(x, lambda s: s.cast("double") * s.cast("double"))) / F.greatest(F.size(x), F.lit(1)))


def rms_db(x: Column) -> Column:
    return 20 * F.log10(rms(x) + F.lit(1e-10))


def active_share(x: Column, frame: int, floor: float = 1e-3) -> Column:
    """Share of whole frames of `frame` samples whose RMS is over the floor; null with less than one frame."""
    n = F.floor(F.size(x) / F.lit(frame)).cast("int")
    frames = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: rms(F.slice(x, i * frame + 1, F.lit(frame))))
    return F.when(n > 0, F.size(F.filter(frames, lambda r: r > floor)) / n)


def semitone_ratio(n: Column) -> Column:
    return F.pow(F.lit(2.0), n / F.lit(12.0))


def concentration(share: Column, centre: Column, low: float = 60.0, high: float = 2000.0) -> Column:
    """A band's share of energy over its share of the width; the band is 0.8 centre wide."""
    return share / (F.lit(0.8) * centre / F.lit(high - low))

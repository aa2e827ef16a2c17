"""Deterministic draws: the same text gives the same number in any process or engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text joined by a bar, first 8 hex digits of its MD5, over 2^32.
SEPARATOR = "|"
HEX_DIGITS = 8
SPAN = 4294967296.0


def stable_bits(*parts) -> Column:
    """First 32 bits of the MD5 of the joined parts, as BIGINT."""
    text = F.concat_ws(SEPARATOR, *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def stable_fraction(*parts) -> Column:
    """A number in [0, 1). Plain strings are literals; pass Columns for data."""
    return stable_bits(*parts) / F.lit(SPAN)


def weighted_choice(fraction: Column, weights: dict) -> Column:
    """Category by cumulative weight, categories in name order.

    Weights are normalised; the last category takes what rounding leaves over. The
    table of weights is a setting, so it becomes a CASE rather than a join.
    """
    names = sorted(weights)
    position = fraction * F.lit(float(sum(weights.values())))
    choice = None
    running = 0.0
    for name in names[:-1]:
        running += weights[name]
        hit = position < F.lit(running)
        choice = F.when(hit, name) if choice is None else choice.when(hit, name)
    return F.lit(names[-1]) if choice is None else choice.otherwise(names[-1])


def flag_with_probability(fraction: Column, probability: float) -> Column:
    return fraction < F.lit(float(probability))


def jittered(base: Column, fraction: Column, jitter: float, places: int = 2) -> Column:
    """Base moved by up to +/- jitter, linear in the fraction."""
    moved = base * (F.lit(1.0) + (fraction * 2 - 1) * F.lit(float(jitter)))
    return F.round(moved, places)

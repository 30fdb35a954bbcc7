"""Scalar helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double, junk and blanks to null (ANSI mode raises on a plain cast)."""
    return F.trim(as_col(c).cast("string")).try_cast("double")


def safe_ratio(a: Column | str, b: Column | str, otherwise: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(as_col(a).cast("double"), as_col(b).cast("double")), F.lit(otherwise))


def clip(c: Column | str, lo: Column | float, hi: Column | float) -> Column:
    """Null stays null, which ``least``/``greatest`` alone would not give."""
    x = as_col(c)
    lo, hi = (v if isinstance(v, Column) else F.lit(float(v)) for v in (lo, hi))
    return F.when(x.isNotNull(), F.greatest(F.least(x, hi), lo))


def currency(c: Column | str) -> Column:
    x = as_col(c)
    return F.concat(F.lit("$"), F.format_number(x, 2))


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(as_col(c) * 100, digits), F.lit("%"))


def iso_timestamp(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_stamp(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyyMMdd_HHmmss")


def count_equal(cols: Sequence[str], value: str) -> Column:
    """How many of the columns hold the value; nulls do not count."""
    return sum((F.col(c).eqNullSafe(F.lit(value)).cast("int") for c in cols), F.lit(0))


def count_not_equal(cols: Sequence[str], value: str) -> Column:
    """How many of the columns differ from the value; a null differs."""
    return sum(((~F.col(c).eqNullSafe(F.lit(value))).cast("int") for c in cols), F.lit(0))


def order_key(key: Column | str, seed: int = 42) -> Column:
    """A reproducible random order: the same row always draws the same place, however data is split."""
    return F.md5(F.concat(as_col(key).cast("string"), F.lit(f":{seed}")))


def unit_draw(key: Column | str, seed: int | str = 42) -> Column:
    """A reproducible number in [0, 1) per key, from the first 32 bits of the order key."""
    digest = F.md5(F.concat(as_col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def poisson_count(draw: Column, mean: float) -> Column:
    """The Poisson variate at a uniform draw: how many cumulative probabilities the draw reaches."""
    steps, chance, below = [], exp(-mean), exp(-mean)
    while len(steps) < mean or chance > 1e-12:
        steps.append(F.when(draw >= below, 1).otherwise(0))
        chance *= mean / len(steps)
        below += chance
    return sum(steps, F.lit(0))

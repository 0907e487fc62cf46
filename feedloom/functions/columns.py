"""Scalar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The log's 12-hour time format, and what one piece of a packed impression is.
LOG_TIME_FORMAT = "M/d/yyyy h:mm:ss a"
PACKED_ITEM_PATTERN = r"^.+-\d$"

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def decimals(value: Column, digits: int = 6) -> Column:
    """Round half up by plain double arithmetic, so other engines give the same bits."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970, whichever timestamp type the column has."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        micros = F.timestamp_diff("MICROSECOND", origin, F.col(name))
        million = F.lit(1_000_000).cast("long")
        return ((micros - F.pmod(micros, million)) / million).cast("long")
    return F.unix_seconds(F.col(name).cast("timestamp"))


def word_count(text: Column) -> Column:
    """Number of space-separated pieces, 0 for null."""
    return F.when(text.isNotNull(), F.size(F.split(text, " "))).otherwise(0)


def has_text(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def turn(position: Column, period: float, wave=F.sin) -> Column:
    """Place a cyclic quantity on the unit circle."""
    return wave(position * F.lit(2.0 * math.pi) / F.lit(period))


def half_life_decay(age: Column, half_life: float) -> Column:
    """1 at age zero, one half after each half life; negative ages count as zero."""
    return F.exp(F.greatest(age, F.lit(0.0)) * F.lit(-math.log(2.0) / half_life))


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """part / whole, with a fixed value where whole is zero."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))

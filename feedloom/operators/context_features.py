"""Features of the moment and place an item was shown in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.columns import turn
from feedloom.functions.frames import positions


def time_features(interactions: DataFrame, dow_base: str = "monday") -> DataFrame:
    """Hour, day of week, both as points on a circle, and a weekend flag.

    ``dow_base="monday"`` counts 0 = Monday, so that 5 and 6 are the weekend;
    ``"sunday"`` counts 0 = Sunday with the same flag rule.
    """
    if "timestamp" in interactions.columns:
        at = F.col("timestamp")
    else:
        at = F.timestamp_seconds(F.col("timestamp_unix"))
    day = F.weekday(at) if dow_base == "monday" else F.dayofweek(at) - 1
    return (
        interactions.withColumn("ctx_hour", F.hour(at))
        .withColumn("ctx_day_of_week", day)
        .withColumns(
            {
                "ctx_hour_sin": turn(F.col("ctx_hour"), 24.0, F.sin),
                "ctx_hour_cos": turn(F.col("ctx_hour"), 24.0, F.cos),
                "ctx_dow_sin": turn(F.col("ctx_day_of_week"), 7.0, F.sin),
                "ctx_dow_cos": turn(F.col("ctx_day_of_week"), 7.0, F.cos),
                "ctx_is_weekend": F.when(F.col("ctx_day_of_week") >= 5, 1).otherwise(0),
            }
        )
    )


CHUNKS = 128


def _id_number(df: DataFrame, name: str) -> Column:
    """A whole number that does not decrease along the ids.

    Of a text, the seven bytes after the beginning that all ids share, which is
    the one that the first and the last have in common.
    """
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.floor(F.col(name)).cast("long")
    raw = F.encode(F.col(name), "UTF-8")
    first, last = F.col("first"), F.col("last")
    alike = F.filter(
        F.sequence(F.lit(0), F.least(F.length(first), F.length(last))),
        lambda i: F.substring(first, F.lit(1), i) == F.substring(last, F.lit(1), i),
    )
    ends = df.agg(F.min(raw).alias("first"), F.max(raw).alias("last"))
    shared = ends.select(F.coalesce(F.size(alike) - 1, F.lit(0)).alias("n")).scalar()
    digits = F.rpad(F.hex(F.substring(raw, shared + 1, F.lit(7))), 14, "0")
    return F.conv(digits, 16, 10).cast("long")


def item_chunk(df: DataFrame, name: str = "news_id") -> Column:
    """Order-keeping chunk of an item id: which of CHUNKS stretches of about equal rows it is in."""
    number = _id_number(df, name)
    shares = [i / CHUNKS for i in range(1, CHUNKS)]
    bounds = df.agg(F.approx_percentile(number, shares, 10 * CHUNKS).alias("b")).scalar()
    # Sorted in among the bounds, the id comes after all bounds below it.
    return F.array_position(F.sort_array(F.array_append(bounds, number)), number)


def position_features(
    interactions: DataFrame, chunks: Sequence[Column] | None = None, rows_per_task: int = 100_000
) -> DataFrame:
    """Position of each item in its impression by item id, impression size, and their ratio.

    Impressions are numbered whole where none has over ``rows_per_task`` rows, else chunk by chunk.
    """
    rest = [c for c in interactions.columns if c not in ("news_id", "impression_id")]
    order = [F.col("news_id"), *[F.col(c) for c in rest if c in ("user_id", "timestamp_unix")]]
    names = {"position": "ctx_position_in_impression", "size": "ctx_impression_size"}
    sizes = interactions.groupBy("impression_id").agg(F.count("*").alias("n"))
    if chunks is None and (sizes.agg(F.max("n")).first()[0] or 0) <= rows_per_task:
        whole = Window.partitionBy("impression_id")
        number = F.row_number().over(whole.orderBy(*order)).cast("long")
        placed = interactions.withColumns(
            {names["position"]: number, names["size"]: F.count("*").over(whole.orderBy(*order).rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing))}
        )
    else:
        placed = positions(
            interactions, ["impression_id"], chunks or [item_chunk(interactions)], order, **names
        )
    return placed.withColumn(
        "ctx_normalized_position",
        F.col("ctx_position_in_impression") / F.col("ctx_impression_size"),
    )


def build_context_features(interactions: DataFrame, dow_base: str = "monday") -> DataFrame:
    """All ten context columns."""
    return position_features(time_features(interactions, dow_base))

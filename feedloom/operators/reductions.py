"""The log reduced once: rows per user and item, and per user and taste."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import merged


def user_items(interactions: DataFrame) -> DataFrame:
    """One row per user and item; user, item and taste features are sums over these.

    ``latest`` is the last time with the history length then, in logs that tell it.
    """
    last = ["timestamp_unix", *[c for c in ("history_length",) if c in interactions.columns]]
    latest = F.max(F.struct(*last))
    return interactions.groupBy("user_id", "news_id").agg(
        F.count("*").alias("n"),
        F.sum("label").alias("label_sum"),
        F.count("label").alias("labelled"),
        F.count_if(F.col("label") == 1).alias("clicks"),
        F.min("timestamp_unix").alias("first_ts"),
        F.max("timestamp_unix").alias("last_ts"),
        latest.alias("latest"),
    )


def clicked(interactions: DataFrame) -> DataFrame:
    """Clicks per user and item, where there are any."""
    only = interactions.filter(F.col("label") == 1)
    return only.groupBy("user_id", "news_id").agg(F.count("*").alias("clicks"))


def tastes(clicks: DataFrame, news: DataFrame) -> DataFrame:
    """Clicks per user, category and subcategory; ``listed`` tells whether the catalogue has the items.

    Top category, diversity and both kinds of shares are sums over this table.
    """
    catalogue = news.select("news_id", "category", "subcategory", F.lit(True).alias("listed"))
    return (
        clicks.join(merged(catalogue), "news_id", "left")
        .groupBy("user_id", "category", "subcategory", F.col("listed").isNotNull().alias("listed"))
        .agg(F.sum("clicks").alias("clicks"))
    )

"""How much of a user's clicking goes to a category or subcategory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.reductions import clicked, tastes


def taste_shares(interactions: DataFrame, news: DataFrame, level: str = "category") -> DataFrame:
    """Clicks per user and category (or subcategory) and their share of the user's clicks."""
    table = tastes(clicked(interactions), news).filter("listed")
    name = f"user_{level}"
    summed = table.groupBy("user_id", level).agg(F.sum("clicks").alias(f"{name}_clicks"))
    everything = F.sum(f"{name}_clicks").over(Window.partitionBy("user_id"))
    return summed.withColumn(f"{name}_share", F.col(f"{name}_clicks") / everything)


def _profiles(table: DataFrame) -> DataFrame:
    """One row per user: all clicks, and maps from category and subcategory to clicks.

    The maps hold a user's distinct categories, so they are as long as the
    catalogue has categories at most; a user without any has none.
    """
    listed = table.filter("listed")

    def counted(level: str) -> DataFrame:
        # A category comes once per subcategory: its entries are summed under one key.
        summed = listed.groupBy("user_id", level).agg(F.sum("clicks").alias("clicks"))
        named = F.when(F.col(level).isNotNull(), F.struct(level, "clicks"))
        entries = F.map_from_entries(F.collect_list(named))
        return summed.groupBy("user_id").agg(entries.alias(f"_by_{level}"))

    everything = listed.groupBy("user_id").agg(F.sum("clicks").alias("_all"))
    return everything.join(counted("category"), "user_id", "left").join(counted("subcategory"), "user_id", "left")


def with_tastes(
    interactions: DataFrame,
    news: DataFrame,
    learned_from: DataFrame | None = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """Interactions with the user's clicks and share for the item's category and subcategory, else 0.

    ``learned_from`` names the interactions that tastes come from (train, to keep labels
    of later splits out); by default the rows themselves. ``table`` gives them ready-made.
    One join with the catalogue says what an item is, one with a
    row per user what the user likes; the rest is looked up in that row.
    """
    if table is None:
        table = tastes(clicked(interactions if learned_from is None else learned_from), news)
    kinds = news.select(
        "news_id", F.struct("category", "subcategory").alias("_kind")
    )
    rows = interactions.join(_profiles(table), "user_id", "left").join(kinds, "news_id", "left")
    liked = {
        level: F.coalesce(F.col(f"_by_{level}")[F.col(f"_kind.{level}")], F.lit(0).cast("long"))
        for level in ("category", "subcategory")
    }
    shares = {
        f"user_{level}_share": F.coalesce(clicks / F.col("_all"), F.lit(0.0))
        for level, clicks in liked.items()
    }
    return rows.withColumns({"user_category_clicks": liked["category"], **shares}).drop(
        "_all", "_by_category", "_by_subcategory", "_kind"
    )

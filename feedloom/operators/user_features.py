"""Per-user features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.columns import ratio
from feedloom.operators.reductions import clicked, tastes, user_items

SECONDS_PER_DAY = 86_400


def _stats_columns() -> list:
    return [
        F.sum("n").alias("user_total_interactions"),
        F.coalesce(F.sum("label_sum"), F.lit(0)).alias("user_total_clicks"),
        F.coalesce(F.sum("label_sum") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0)).alias(
            "user_ctr"
        ),
        F.count("news_id").alias("user_unique_items"),
        F.max("last_ts").alias("user_last_interaction_ts"),
        F.min("first_ts").alias("user_first_interaction_ts"),
        F.max("latest")["history_length"].alias("user_history_length"),
        F.count_if((F.col("clicks") > 0) & F.col("news_id").isNotNull()).alias(
            "user_unique_clicked_items"
        ),
    ]


def _with_rates(stats: DataFrame) -> DataFrame:
    span = F.col("user_last_interaction_ts") - F.col("user_first_interaction_ts")
    return stats.withColumns(
        {"user_active_duration_days": F.greatest(span / SECONDS_PER_DAY, F.lit(1.0))}
    ).withColumns(
        {
            "user_interaction_frequency": F.col("user_total_interactions")
            / F.col("user_active_duration_days"),
            "user_click_diversity": ratio(
                F.col("user_unique_clicked_items"), F.col("user_total_clicks")
            ),
        }
    )


def user_stats(interactions: DataFrame) -> DataFrame:
    """Counts, click rate, first and last time, activity rate and click diversity.

    Two-step aggregation: distinct items fall out of the (user, item) rows, so
    no distinct aggregate and no self-join is needed. The history length is that
    of the latest interaction, the longest one if several share the last second.
    """
    return _with_rates(user_items(interactions).groupBy("user_id").agg(*_stats_columns()))


def _top_category(taste: DataFrame) -> DataFrame:
    per_category = taste.groupBy("user_id", "category").agg(F.sum("clicks").alias("clicks"))
    best = F.min(F.struct((-F.col("clicks")).alias("_less"), "category"))
    return per_category.groupBy("user_id").agg(best.alias("_best")).select(
        "user_id",
        F.col("_best")["category"].alias("user_top_category"),
        (-F.col("_best")["_less"]).alias("user_top_category_clicks"),
    )


def _category_counts(taste: DataFrame) -> DataFrame:
    return taste.groupBy("user_id").agg(
        F.count_distinct("category").alias("user_category_diversity"),
        F.count_distinct("subcategory").alias("user_subcategory_diversity"),
    )


def user_top_category(interactions: DataFrame, news: DataFrame) -> DataFrame:
    """Most clicked category of each user; ties go to the first name."""
    return _top_category(tastes(clicked(interactions), news))


def category_diversity(interactions: DataFrame, news: DataFrame) -> DataFrame:
    """Distinct categories and subcategories clicked, 0 for users without clicks."""
    taste = _category_counts(tastes(clicked(interactions), news))
    users = interactions.select("user_id").distinct()
    return users.join(taste, "user_id", "left").fillna(0)


def session_stats(interactions: DataFrame) -> DataFrame:
    """Impression sizes and clicks, averaged per user."""
    sessions = interactions.groupBy("user_id", "impression_id").agg(
        F.count("*").alias("rows"), F.sum("label").alias("clicks")
    )
    return sessions.groupBy("user_id").agg(
        F.count("*").alias("user_total_sessions"),
        F.avg("rows").alias("user_avg_session_size"),
        F.avg("clicks").alias("user_avg_session_clicks"),
        F.max("rows").alias("user_max_session_size"),
    )


def build_user_features(
    interactions: DataFrame,
    news: DataFrame,
    reduced: DataFrame | None = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """One row per user with all user features; missing numbers are 0.

    The log is read twice, once by (user, item) and once by (user, impression);
    ``reduced`` and ``table`` are its rows per user and item and per taste where they are known.
    The four per-user results are already partitioned by user_id, so joining
    them moves nothing further.
    """
    per_item = user_items(interactions) if reduced is None else reduced
    if table is None:
        table = tastes(per_item.filter(F.col("clicks") > 0).select("user_id", "news_id", "clicks"), news)
    stats = _with_rates(per_item.groupBy("user_id").agg(*_stats_columns()))
    return (
        stats.join(_top_category(table).drop("user_top_category_clicks"), "user_id", "left")
        .join(_category_counts(table), "user_id", "left")
        .join(session_stats(interactions), "user_id", "left")
        .fillna(0)
    )

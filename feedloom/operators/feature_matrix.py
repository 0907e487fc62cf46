"""The feature matrix: every interaction with its user, item, context and taste features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.frames import merged
from feedloom.operators.context_features import build_context_features
from feedloom.operators.item_features import build_item_features
from feedloom.operators.reductions import tastes, user_items
from feedloom.operators.tastes import with_tastes
from feedloom.operators.user_features import build_user_features
from feedloom.sources.logs import SPLITS

# Columns that never serve as model inputs.
NOT_FEATURES = (
    "user_id",
    "news_id",
    "label",
    "impression_id",
    "timestamp",
    "timestamp_unix",
    "history",
    "history_items",
    "history_length",
    "title",
    "abstract",
    "url",
    "title_entities",
    "abstract_entities",
    "user_top_category",
    "category",
    "subcategory",
    "item_first_seen_ts",
    "item_last_seen_ts",
    "user_first_interaction_ts",
    "user_last_interaction_ts",
    "source",
    "candidate_score",
)


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that may serve as model inputs, sorted by name."""
    return sorted(
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES
    )


def feature_matrix(
    interactions: DataFrame,
    news: DataFrame,
    dow_base: str = "monday",
    user_clusters: DataFrame | None = None,
) -> DataFrame:
    """Join all feature families onto split-tagged interactions.

    User, item and taste features come from the train split alone, reduced once. All
    splits are joined in one pass; unknown users and items get 0.
    ``user_clusters`` (user_id, user_cluster) adds the segment as a feature.
    """
    train = interactions.filter(F.col("split") == "train")
    reduced = user_items(train)
    table = tastes(reduced.filter(F.col("clicks") > 0).select("user_id", "news_id", "clicks"), news)
    users = build_user_features(train, news, reduced, table)
    if user_clusters is not None:
        users = users.join(user_clusters, "user_id", "left")
    items = build_item_features(train, news, reduced=reduced)
    rows = with_tastes(build_context_features(interactions, dow_base), news, table=table)
    new_items = [c for c in items.columns if c == "news_id" or c not in rows.columns]
    joined = rows.join(users, "user_id", "left").join(items.select(*new_items), "news_id", "left")
    # These hold no NaN, so a plain coalesce will do: it keeps the generated method small enough to be compiled.
    clusters = [] if user_clusters is None else user_clusters.columns
    ready = {*users.columns, *new_items} - {*rows.columns, *news.columns, *clusters}
    filled = {
        f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        for f in joined.schema.fields
        if f.name in ready and isinstance(f.dataType, T.NumericType)
    }
    return joined.fillna(0, [c for c in joined.columns if c not in filled]).withColumns(filled)


def candidate_features(
    rows: DataFrame,
    news: DataFrame,
    table: DataFrame,
    at: int,
    dow_base: str = "monday",
) -> DataFrame:
    """Candidates with the context and taste columns that rankers are trained on.

    ``rows`` hold user_id, news_id and both sides' features. A user's
    candidates are looked at as one impression shown at the second ``at``;
    ``table`` are tastes (``reductions.tastes``) of the users' past.
    """
    shown = rows.withColumns(
        {"impression_id": F.col("user_id"), "timestamp_unix": F.lit(at).cast("long")}
    )
    return with_tastes(build_context_features(shown, dow_base), merged(news), table=table).fillna(0)


def run_feature_pipeline(interactions: DataFrame, news: DataFrame, **options) -> dict[str, DataFrame]:
    """User features, item features and one enriched frame per split."""
    train = interactions.filter(F.col("split") == "train")
    matrix = feature_matrix(interactions, news, **options)
    enriched = {s: matrix.filter(F.col("split") == s).drop("split") for s in SPLITS}
    return {
        "user_features": build_user_features(train, news),
        "item_features": build_item_features(train, news),
        **enriched,
    }

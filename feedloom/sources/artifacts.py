"""Fitted artifacts: score tables, comparison tables, and what serving loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.boosting import TreeRanker
from feedloom.operators.popularity import lookup_scores
from feedloom.sources.logs import path_exists


def save_scores(scores: DataFrame, folder: str, as_json: bool = False) -> None:
    """Item scores as Parquet, or as JSON lines."""
    writer = scores.select("news_id", "score").write.mode("overwrite")
    writer.json(f"{folder}/item_scores") if as_json else writer.parquet(f"{folder}/item_scores")


def load_scores(spark: SparkSession, folder: str, news_id_type: str = "string", as_json: bool = False):
    if as_json:
        return spark.read.schema(f"news_id {news_id_type}, score double").json(
            f"{folder}/item_scores"
        )
    return spark.read.parquet(f"{folder}/item_scores")


def save_comparison(table: DataFrame, folder: str) -> None:
    """A model comparison (one row per model) as one CSV file."""
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(
        f"{folder}/model_comparison"
    )


@dataclass
class ServingInputs:
    """What recommendations need: a scorer and, where written, user and item features."""

    model_type: str
    scorer: object
    user_features: DataFrame | None
    item_features: DataFrame | None


def load_serving(spark: SparkSession, artifacts: str, features: str) -> ServingInputs:
    """The tree ranker if there is one, else the popularity baseline; features if present."""
    if path_exists(spark, f"{artifacts}/tree_ranker/forest"):
        ranker = TreeRanker.load(spark, f"{artifacts}/tree_ranker")
        kind, scorer = "tree_ranker", ranker.score
    elif path_exists(spark, f"{artifacts}/baseline/item_scores"):
        scores = load_scores(spark, f"{artifacts}/baseline")
        kind, scorer = "popularity_baseline", lambda rows: lookup_scores(rows, scores)
    else:
        raise FileNotFoundError(f"no fitted ranker under {artifacts}")

    def optional(name: str) -> DataFrame | None:
        path = f"{features}/{name}"
        return spark.read.parquet(path) if path_exists(spark, path) else None

    return ServingInputs(kind, scorer, optional("user_features"), optional("item_features"))

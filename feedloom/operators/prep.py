"""From packed behaviour rows to clean, time-split interactions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.columns import (
    PACKED_ITEM_PATTERN,
    epoch_seconds,
    has_text,
)
from feedloom.functions.frames import approximate_quantiles, exact_quantiles, written

INTERACTION_KEY = ("user_id", "news_id", "impression_id")


def parse_impressions(behaviors: DataFrame) -> DataFrame:
    """One row per shown item; pieces that are not ``id-digit`` are dropped."""
    rest = [c for c in behaviors.columns if c != "impressions"]
    # The pattern drops null; a plain explode would split twice, for a filter on the number of pieces too.
    pieces = behaviors.select(*rest, F.explode_outer(F.split("impressions", " ")).alias("_piece"))
    # The pattern fixes the last two characters, so one match serves id and label.
    piece = F.col("_piece")
    item = F.substring(piece, F.lit(1), F.length(piece) - 2)
    return pieces.filter(piece.rlike(PACKED_ITEM_PATTERN)).select(
        *rest, item.alias("news_id"), F.right(piece, F.lit(1)).cast("int").alias("label")
    )


def parse_history(behaviors: DataFrame) -> DataFrame:
    """History text to an array and its length; blank or null gives an empty array."""
    history = F.col("history")
    items = F.when(has_text(history), F.split(history, " ")).otherwise(
        F.array().cast("array<string>")
    )
    return behaviors.withColumn("history_items", items).withColumn(
        "history_length", F.size("history_items")
    )


def drop_incomplete(interactions: DataFrame) -> DataFrame:
    return interactions.dropna(subset=["user_id", "news_id", "label"])


def keep_known_items(interactions: DataFrame, news: DataFrame) -> DataFrame:
    """Interactions whose item is in the catalogue."""
    return interactions.join(news.select("news_id"), "news_id", "left_semi")


def unknown_items(interactions: DataFrame, news: DataFrame) -> DataFrame:
    """Interactions whose item is not in the catalogue."""
    return interactions.join(news.select("news_id"), "news_id", "left_anti")


def _time_column(df: DataFrame) -> str:
    return "timestamp" if "timestamp" in df.columns else "timestamp_unix"


def dedup_interactions(interactions: DataFrame) -> DataFrame:
    """One row per user, item and impression.

    The survivor is fixed: the earliest, then the one with the highest label,
    then the smallest by its other columns. An aggregate, so copies of one row
    are reduced before the shuffle.
    """
    time = _time_column(interactions)
    rest = [c for c in interactions.columns if c not in (*INTERACTION_KEY, time, "label")]
    kept = F.min(F.struct(time, (-F.col("label")).alias("_unlabel"), *rest)).alias("_kept")
    grouped = interactions.groupBy(*INTERACTION_KEY).agg(kept)
    values = {c: F.col("_kept")[c] for c in (time, *rest)}
    values["label"] = -F.col("_kept")["_unlabel"]
    return grouped.select(
        *[values.get(c, F.col(c)).alias(c) for c in interactions.columns]
    )


def add_epoch(interactions: DataFrame) -> DataFrame:
    return interactions.withColumn("timestamp_unix", epoch_seconds(interactions, "timestamp"))


def _quantiles(df: DataFrame, column: str, probabilities, rel_error: float) -> DataFrame:
    if rel_error > 0:
        return approximate_quantiles(df, column, probabilities, rel_error)
    return exact_quantiles(df, column, probabilities)


def impute_median_time(interactions: DataFrame, rel_error: float = 0.0) -> DataFrame:
    """Give rows without a time the median time."""
    median = _quantiles(interactions, "timestamp_unix", ["0.5"], rel_error).first()["q0"]
    return interactions.withColumn(
        "timestamp_unix", F.coalesce(F.col("timestamp_unix"), F.lit(median).cast("long"))
    )


def split_bounds(
    interactions: DataFrame,
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    rel_error: float = 0.0,
) -> DataFrame:
    """One row: the last second of train (q0) and of val (q1)."""
    if not math.isclose(train + val + test, 1.0, abs_tol=1e-6):
        raise ValueError("split ratios must sum to 1")
    probabilities = [f"{train:.6f}", f"{train + val:.6f}"]
    return _quantiles(interactions, "timestamp_unix", probabilities, rel_error)


def time_split(
    interactions: DataFrame,
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    rel_error: float = 0.0,
) -> DataFrame:
    """Tag each row train, val or test by time, so nothing later leaks into train.

    The two bounds are fetched first (two numbers), so that a filter on the
    split becomes a plain time range that reaches the scan.
    """
    found = split_bounds(interactions, train, val, test, rel_error).first()
    first, second = (F.lit(found[q]).cast("long") for q in ("q0", "q1"))
    at = F.col("timestamp_unix")
    split = F.when(at <= first, "train").when(at <= second, "val").otherwise("test")
    return interactions.withColumn("split", split)


def prepare(behaviors: DataFrame, news: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    """Parsed behaviours to clean interactions with a split column.

    The cleaned rows are written once; the median, the split bounds and the
    result read them from there.
    """
    parsed = parse_history(parse_impressions(behaviors))
    kept = keep_known_items(drop_incomplete(parsed), news)
    if remove_duplicates:
        kept = dedup_interactions(kept)
    return time_split(impute_median_time(written(add_epoch(kept))))


def prep_statistics(behaviors: DataFrame, news: DataFrame) -> DataFrame:
    """The counters of a preparation run, as one row.

    Copies are counted, not collected: parsed rows are first reduced to one
    row per user, item and impression, which also serves the catalogue check.
    """
    parsed = add_epoch(parse_history(parse_impressions(behaviors)))
    complete = (
        F.col("user_id").isNotNull() & F.col("news_id").isNotNull() & F.col("label").isNotNull()
    )
    survivor = F.min(F.struct("timestamp_unix", (-F.col("label")).alias("unlabel")))
    keyed = written(
        parsed.withColumn("_complete", complete)
        .groupBy(*INTERACTION_KEY, "_complete")
        .agg(
            F.count("*").alias("copies"),
            survivor.alias("kept"),
            F.bool_or(F.col("history_length") == 0).alias("_no_history"),
        )
        .join(news.select("news_id", F.lit(True).alias("_known")), "news_id", "left")
        .withColumn("_known", F.col("_complete") & F.col("_known").isNotNull())
        .withColumn("label", -F.col("kept")["unlabel"])
        .withColumn("timestamp_unix", F.col("kept")["timestamp_unix"])
    )
    clean = time_split(impute_median_time(keyed.filter("_known")))

    def split_rows(name: str):
        return F.count_if(F.col("split") == name)

    kept_stats = clean.agg(
        F.count("*").alias("total_interactions"),
        F.count_if(F.col("label") == 1).alias("positive_interactions"),
        F.count_if(F.col("label") == 0).alias("negative_interactions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("news_id").alias("unique_items"),
        split_rows("train").alias("train_size"),
        split_rows("val").alias("val_size"),
        split_rows("test").alias("test_size"),
    )
    removed = keyed.agg(
        F.coalesce(F.sum(F.when(~F.col("_complete"), F.col("copies"))), F.lit(0)),
        F.coalesce(
            F.sum(F.when(F.col("_complete") & ~F.col("_known"), F.col("copies"))), F.lit(0)
        ),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("copies") - 1)), F.lit(0)),
    ).toDF("removed_malformed", "removed_invalid_ids", "removed_duplicates")
    catalogue = news.agg(
        F.count_distinct("news_id").alias("raw_news"),
        (
            F.count_distinct("category") + F.max(F.col("category").isNull().cast("int"))
        ).alias("categories"),
    )
    raw = behaviors.agg(F.count("*").alias("raw_behaviors"))
    empty = keyed.filter("_no_history").agg(
        F.count_distinct("user_id").alias("users_with_empty_history")
    )
    out = kept_stats
    for part in (removed, catalogue, raw, empty):
        # one-row frames, read as scalar subqueries
        packed = part.select(F.struct("*").alias("r")).scalar()
        out = out.withColumn("_r", packed).select("*", "_r.*").drop("_r")
    return out.withColumn("total_impressions", F.col("raw_behaviors"))

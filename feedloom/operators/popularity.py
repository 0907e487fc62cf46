"""Popularity scores, lists and candidates, and the popularity baseline ranker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.columns import decimals
from feedloom.functions.frames import merged, top_per_group, written


def popularity_score(items: DataFrame, time_decay: bool = True) -> DataFrame:
    """Clicks, weighted by freshness unless time_decay is off or there is none."""
    clicks = F.col("item_total_clicks").cast("double")
    if time_decay and "item_freshness_score" in items.columns:
        clicks = clicks * F.col("item_freshness_score")
    return items.withColumn("popularity_score", clicks)


def _by_score() -> list[Column]:
    # Ties go to the smaller id; rounding keeps equal scores equal.
    return [F.desc("_order"), F.asc("news_id")]


def popular_global(items: DataFrame, top_n: int = 100, time_decay: bool = True) -> DataFrame:
    """The top_n items by popularity score, with their rank."""
    scored = popularity_score(items, time_decay).withColumn(
        "_order", decimals(F.col("popularity_score"))
    )
    best = scored.orderBy(*_by_score()).limit(top_n)
    # at most top_n rows reach this point
    listed = best.agg(
        F.sort_array(
            F.collect_list(
                F.struct((-F.col("_order")).alias("less"), "news_id", "popularity_score", "category")
            )
        ).alias("l")
    )
    return listed.select(F.posexplode("l").alias("at", "e")).select(
        (F.col("at") + 1).alias("rank"), "e.news_id", "e.category", "e.popularity_score"
    )


def popular_by_category(items: DataFrame, top_n: int = 100, time_decay: bool = True) -> DataFrame:
    """The top_n // 5 items of each category, with their rank."""
    scored = popularity_score(items, time_decay).withColumn(
        "_order", decimals(F.col("popularity_score"))
    )
    known = scored.filter(F.col("category").isNotNull())
    return top_per_group(known, ["category"], _by_score(), top_n // 5).select(
        "category", "rank", "news_id", "popularity_score"
    )


def _as_list(ranked: DataFrame, *group: str) -> DataFrame:
    """Ranked rows of a short list as one array of ids in rank order."""
    ids = F.transform(F.sort_array(F.collect_list(F.struct("rank", "news_id"))), lambda e: e.news_id)
    return ranked.groupBy(*group).agg(ids.alias("ids"))


def popularity_lists(
    users: DataFrame,
    seen: DataFrame,
    items: DataFrame,
    n: int,
    top_n: int = 100,
    wanted: str | None = None,
) -> DataFrame:
    """Per user an array of up to n (or the number in column ``wanted``) popularity candidates in rank order.

    ``users``: user_id, user_top_category. ``seen``: distinct user_id, news_id to
    leave out. Up to n // 3 come from the user's top category, the rest from the
    global list. Both lists are short by definition (top_n and top_n // 5), so
    they ride along as arrays: no user-by-item rows are made.
    """
    overall = written(popular_global(items, top_n))
    by_category = written(popular_by_category(items, top_n))
    global_ids = _as_list(overall).scalar()
    category_ids = _as_list(by_category, "category").withColumnRenamed("ids", "category_ids")
    listed = overall.select("news_id").union(by_category.select("news_id")).distinct()
    # bounded by the lists: at most every listed item per user
    seen_listed = (
        seen.join(listed, "news_id", "left_semi")
        .groupBy("user_id")
        .agg(F.collect_set("news_id").alias("seen_ids"))
    )
    empty = F.filter(F.col("global_ids"), lambda x: F.lit(False))
    limit = F.lit(n) if wanted is None else F.col(wanted)
    lists = (
        users.join(category_ids, users["user_top_category"] == category_ids["category"], "left")
        .join(merged(seen_listed), "user_id", "left")
        .withColumn("global_ids", global_ids)
        .withColumn("seen_ids", F.coalesce("seen_ids", empty))
        .withColumn(
            "own",
            F.slice(
                F.array_except(F.coalesce("category_ids", empty), F.col("seen_ids")),
                F.lit(1),
                F.floor(limit / 3).cast("int"),
            ),
        )
        .withColumn(
            "rest",
            F.slice(
                F.array_except(F.col("global_ids"), F.concat("seen_ids", "own")),
                F.lit(1),
                limit - F.size("own"),
            ),
        )
    )
    size = F.greatest(F.size("own") + F.size("rest"), F.lit(1))

    def tagged(ids: str, source: str, offset: Column) -> Column:
        return F.transform(
            F.col(ids),
            lambda x, i: F.struct(
                x.alias("news_id"),
                F.lit(source).alias("source"),
                (F.lit(1.0) - (i + offset) / size).alias("candidate_score"),
            ),
        )

    both = F.concat(
        tagged("own", "popularity_category", F.lit(0)),
        tagged("rest", "popularity_global", F.size("own")),
    )
    return lists.select("user_id", both.alias("candidates"))


def explode_candidates(lists: DataFrame) -> DataFrame:
    """Candidate arrays to rows with a 1-based rank.

    A plain explode would put a filter on the arrays' sizes below the joins, where all their
    expressions are written out and run again for every element.
    """
    rows = lists.select("user_id", F.posexplode_outer("candidates").alias("at", "c"))
    return rows.filter(F.col("at").isNotNull()).select("user_id", (F.col("at") + 1).alias("rank"), "c.*")


def popularity_candidates(
    users: DataFrame, seen: DataFrame, items: DataFrame, n: int = 100, top_n: int = 100
) -> DataFrame:
    return explode_candidates(popularity_lists(users, seen, items, n, top_n))


def baseline_scores(
    items: DataFrame, recency_weight: float = 0.3, time_decay: bool = True
) -> DataFrame:
    """(news_id, score): (1 - w) * clicks / most clicks + w * freshness."""
    most = items.agg(F.max("item_total_clicks").alias("m")).scalar()
    clicks = F.when(most > 0, F.col("item_total_clicks") / most).otherwise(0.0)
    if time_decay and "item_freshness_score" in items.columns:
        fresh = F.col("item_freshness_score")
    else:
        fresh = F.lit(1.0)
    score = clicks * F.lit(1.0 - recency_weight) + fresh * F.lit(recency_weight)
    return items.select("news_id", score.alias("score"))


def lookup_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach the score of each row's item, 0.0 for an unknown item."""
    return rows.join(scores, "news_id", "left").fillna({"score": 0.0})


def baseline_rank(items: DataFrame, scores: DataFrame, top_k: int = 10) -> DataFrame:
    """The top_k of the given items by baseline score."""
    scored = lookup_scores(items.select("news_id"), scores)
    return scored.orderBy(F.desc(decimals(F.col("score"))), "news_id").limit(top_k)

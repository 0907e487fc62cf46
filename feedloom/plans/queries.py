"""Every registered query: a callable from (spark, folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.columns import decimals
from feedloom.functions.frames import written
from feedloom.operators import attribution, boosting, collaborative, content, context_features
from feedloom.operators import item_features, metrics
from feedloom.operators import neural, pairwise, segments
from feedloom.operators import pool, popularity, prep, rerank, tastes, user_features
from feedloom.operators import recommend as recommending
from feedloom.operators.feature_matrix import candidate_features, feature_columns
from feedloom.operators.feature_matrix import feature_matrix as build_matrix
from feedloom.operators.reductions import clicked, tastes as taste_table
from feedloom.operators.tree_attribution import tree_attribution
from feedloom.plans import tables
from feedloom.sources.logs import drop_blank_impressions, parse_log_time

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, *columns: str) -> DataFrame:
    """Pick columns; whole numbers as bigint, doubles rounded, for comparison with SQL."""
    picked = df.select(*columns) if columns else df
    out = []
    for f in picked.schema.fields:
        kind = f.dataType.typeName()
        column = F.col(f.name)
        if kind in ("integer", "short", "byte"):
            column = column.cast("long")
        elif kind in ("double", "float"):
            column = decimals(column.cast("double"))
        out.append(column.alias(f.name))
    return picked.select(*out)


def _behaviors(spark, folder):
    return parse_log_time(drop_blank_impressions(tables.packed_log(spark, folder)))


def _epoch(df):
    return prep.add_epoch(df).drop("timestamp")


# Preparation


@query
def parse_impressions(spark, folder):
    parsed = prep.parse_impressions(_behaviors(spark, folder))
    return tidy(_epoch(parsed), "impression_id", "user_id", "news_id", "label", "timestamp_unix")


@query
def parse_history(spark, folder):
    parsed = prep.parse_history(tables.packed_log(spark, folder))
    return tidy(
        parsed.select(
            "impression_id",
            "user_id",
            "history_length",
            F.concat_ws("|", "history_items").alias("history_items"),
        )
    )


@query
def valid_items(spark, folder):
    parsed = prep.drop_incomplete(prep.parse_impressions(_behaviors(spark, folder)))
    known = prep.keep_known_items(parsed, tables.packed_news(spark, folder))
    return tidy(known, "impression_id", "user_id", "news_id", "label")


@query
def invalid_items(spark, folder):
    parsed = prep.drop_incomplete(prep.parse_impressions(_behaviors(spark, folder)))
    unknown = prep.unknown_items(parsed, tables.packed_news(spark, folder))
    return tidy(unknown, "impression_id", "user_id", "news_id", "label")


@query
def dedup_interactions(spark, folder):
    kept = prep.dedup_interactions(tables.orders_log(spark, folder))
    return tidy(
        kept, "impression_id", "user_id", "news_id", "label", "timestamp_unix", "history_length"
    )


@query
def impute_median_ts(spark, folder):
    parsed = prep.add_epoch(prep.parse_impressions(_behaviors(spark, folder)))
    filled = prep.impute_median_time(parsed)
    return tidy(filled, "impression_id", "user_id", "news_id", "label", "timestamp_unix")


@query
def time_split(spark, folder):
    split = prep.time_split(tables.orders_log(spark, folder))
    return tidy(split, "impression_id", "user_id", "news_id", "label", "timestamp_unix", "split")


@query
def prepared_interactions(spark, folder):
    news = tables.packed_news(spark, folder)
    out = prep.prepare(_behaviors(spark, folder), news)
    return tidy(
        out,
        "impression_id",
        "user_id",
        "news_id",
        "label",
        "history_length",
        "timestamp_unix",
        "split",
    )


@query
def prep_stats(spark, folder):
    news = tables.packed_news(spark, folder)
    return tidy(prep.prep_statistics(_behaviors(spark, folder), news))


# Features


@query
def user_stats(spark, folder):
    return tidy(user_features.user_stats(tables.orders_log(spark, folder)))


@query
def click_diversity(spark, folder):
    stats = user_features.user_stats(tables.orders_log(spark, folder))
    return tidy(
        stats,
        "user_id",
        "user_total_clicks",
        "user_unique_clicked_items",
        "user_click_diversity",
    )


@query
def category_diversity(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(user_features.category_diversity(log, news))


@query
def session_stats(spark, folder):
    return tidy(user_features.session_stats(tables.orders_log(spark, folder)))


@query
def user_top_category(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(user_features.user_top_category(log, news))


@query
def build_user_features(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(user_features.build_user_features(log, news))


@query
def item_stats(spark, folder):
    return tidy(item_features.item_stats(tables.orders_log(spark, folder)))


@query
def smoothed_ctr(spark, folder):
    stats = item_features.item_stats(tables.orders_log(spark, folder))
    return tidy(item_features.smoothed_ctr(stats), "news_id", "item_smoothed_ctr")


@query
def item_freshness(spark, folder):
    stats = item_features.item_stats(tables.events_log(spark, folder))
    return tidy(
        item_features.item_freshness(stats),
        "news_id",
        "item_age_hours",
        "item_recency_hours",
        "item_freshness_score",
    )


@query
def item_content(spark, folder):
    return tidy(
        item_features.item_content(tables.part_news(spark, folder)),
        "news_id",
        "item_title_length",
        "item_abstract_length",
        "item_has_abstract",
    )


@query
def category_popularity(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(item_features.category_popularity(log, news))


@query
def build_item_features(spark, folder):
    log, news = tables.events_log(spark, folder), tables.part_news(spark, folder)
    return tidy(item_features.build_item_features(log, news))


@query
def user_category_share(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(tastes.taste_shares(log, news, "category"))


@query
def user_subcategory_share(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(tastes.taste_shares(log, news, "subcategory"))


@query
def relational_features(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return tidy(
        tastes.with_tastes(log, news),
        "impression_id",
        "user_id",
        "news_id",
        "label",
        "user_category_share",
        "user_category_clicks",
        "user_subcategory_share",
    )


_TIME_COLUMNS = (
    "user_id",
    "news_id",
    "timestamp_unix",
    "ctx_hour",
    "ctx_day_of_week",
    "ctx_hour_sin",
    "ctx_hour_cos",
    "ctx_dow_sin",
    "ctx_dow_cos",
    "ctx_is_weekend",
)


@query
def context_time(spark, folder):
    log = tables.events_log(spark, folder)
    return tidy(context_features.time_features(log), *_TIME_COLUMNS)


@query
def context_time_sunday_base(spark, folder):
    log = tables.events_log(spark, folder)
    return tidy(context_features.time_features(log, dow_base="sunday"), *_TIME_COLUMNS)


@query
def context_position(spark, folder):
    log = prep.dedup_interactions(tables.orders_log(spark, folder))
    return tidy(
        context_features.position_features(log),
        "impression_id",
        "news_id",
        "ctx_position_in_impression",
        "ctx_impression_size",
        "ctx_normalized_position",
    )


def _split_log(spark, folder):
    """Clean, split interactions, written once for all that build on them."""
    return prep.time_split(written(prep.dedup_interactions(tables.orders_log(spark, folder))))


def _matrix(spark, folder):
    return build_matrix(_split_log(spark, folder), tables.part_news(spark, folder))


@query
def feature_matrix(spark, folder):
    return tidy(_matrix(spark, folder).drop("timestamp", "title", "abstract"))


# Popularity


def _events_items(spark, folder):
    log, news = tables.events_log(spark, folder), tables.part_news(spark, folder)
    return written(item_features.build_item_features(log, news))


@query
def popularity_score(spark, folder):
    items = popularity.popularity_score(_events_items(spark, folder))
    return tidy(items, "news_id", "category", "popularity_score")


@query
def popular_global(spark, folder):
    return tidy(popularity.popular_global(_events_items(spark, folder)))


@query
def popular_by_category(spark, folder):
    return tidy(popularity.popular_by_category(_events_items(spark, folder)))


def _events_clicks(spark, folder):
    return written(collaborative.user_clicks(tables.events_log(spark, folder)))


def _events_tastes(spark, folder):
    """Known users of the events log with their top category."""
    log, news = tables.events_log(spark, folder), tables.part_news(spark, folder)
    users = log.select("user_id").distinct()
    top = user_features.user_top_category(log, news).select("user_id", "user_top_category")
    return users.join(top, "user_id", "left")


@query
def cand_popularity(spark, folder):
    clicks = _events_clicks(spark, folder)
    return tidy(
        popularity.popularity_candidates(
            _events_tastes(spark, folder), clicks, _events_items(spark, folder)
        )
    )


@query
def baseline_score(spark, folder):
    return tidy(popularity.baseline_scores(_events_items(spark, folder)))


@query
def baseline_rank(spark, folder):
    scores = popularity.baseline_scores(_events_items(spark, folder))
    asked = tables.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("news_id"))
    return tidy(popularity.baseline_rank(asked, scores))


# Collaborative


@query
def user_jaccard(spark, folder):
    clicks = _events_clicks(spark, folder)
    return tidy(collaborative.user_jaccard(clicks))


@query
def similar_users(spark, folder):
    clicks = _events_clicks(spark, folder)
    return tidy(collaborative.similar_users(clicks))


@query
def cand_collab(spark, folder):
    clicks = _events_clicks(spark, folder)
    return tidy(collaborative.collaborative_candidates(clicks, clicks))


# Re-ranking and metrics


def _scored_log(spark, folder):
    """Orders log with the baseline score of each item learned from train."""
    split = _split_log(spark, folder)
    items = written(
        item_features.build_item_features(
            split.filter(F.col("split") == "train"), tables.part_news(spark, folder)
        )
    )
    wanted = items.select(
        "news_id",
        "category",
        "item_total_clicks",
        "item_smoothed_ctr",
        "item_age_hours",
        "item_freshness_score",
    )
    scores = popularity.baseline_scores(items)
    return split.join(wanted, "news_id", "left").join(scores, "news_id", "left").withColumn(
        "score", decimals(F.coalesce("score", F.lit(0.0)))
    )


def _scored_lines(spark, folder):
    """The held-out rows, which evaluation is about."""
    return _scored_log(spark, folder).filter(F.col("split") == "test")


@query
def freshness_boost(spark, folder):
    boosted = rerank.freshness_boost(_scored_log(spark, folder))
    return tidy(boosted, "impression_id", "user_id", "news_id", "score", "freshness_score")


@query
def ranking_metrics(spark, folder):
    return tidy(metrics.ranking_metrics(_scored_lines(spark, folder)))


@query
def precision_recall(spark, folder):
    means = metrics.evaluate_ranking(_scored_lines(spark, folder))
    return tidy(
        means, "groups", "precision_at_5", "recall_at_5", "precision_at_10", "recall_at_10"
    )


@query
def ndcg(spark, folder):
    means = metrics.evaluate_ranking(_scored_lines(spark, folder))
    return tidy(means, "groups", "ndcg_at_5", "ndcg_at_10")


@query
def map(spark, folder):  # the metric's name
    means = metrics.evaluate_ranking(_scored_lines(spark, folder))
    return tidy(means, "groups", "map_at_5", "map_at_10")


@query
def average_precision(spark, folder):
    return tidy(metrics.average_precision(_scored_lines(spark, folder)))


@query
def diversity_per_list(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    shown = log.join(news.select("news_id", "category"), "news_id", "left")
    return tidy(metrics.list_diversity(shown, news, "impression_id"))


@query
def diversity(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    shown = log.join(news.select("news_id", "category"), "news_id", "left")
    return tidy(metrics.evaluate_diversity(shown, news, "impression_id"))


@query
def model_comparison(spark, folder):
    rows = _scored_lines(spark, folder)
    scorers = {
        "baseline": lambda df: df,
        "clicks": lambda df: df.withColumn("score", F.col("item_total_clicks").cast("double")),
        "smoothed_ctr": lambda df: df.withColumn("score", decimals(F.col("item_smoothed_ctr"))),
    }
    return tidy(metrics.compare_models(rows, scorers))


@query
def model_comparison_ranked(spark, folder):
    """The popularity baseline against a linear ranker with given weights, on held-out rows."""
    log, news = _scored_lines(spark, folder), tables.part_news(spark, folder)
    past = _split_log(spark, folder).filter(F.col("split") == "train")
    rows = written(tastes.with_tastes(log, news, learned_from=past))
    ranker = pairwise.LinearRanker(["item_smoothed_ctr", "user_category_share"], [2.0, 0.5])
    scorers = {
        "baseline": lambda df: df,
        "linear": lambda df: ranker.score(df).withColumn("score", decimals(F.col("score"))),
    }
    return tidy(metrics.compare_models(rows, scorers))


@query
def permutation_importance(spark, folder):
    """How much NDCG@10 of the ranker with given weights loses per shuffled feature."""
    (test,) = _ready_matrix(spark, folder, ["test"], _GIVEN.features)
    return tidy(attribution.permutation_importance(_GIVEN.score, test, _GIVEN.features))


@query
def mmr_rerank(spark, folder):
    scored = _scored_log(spark, folder)
    best = scored.groupBy("user_id", "news_id", "category").agg(
        F.max("score").alias("score"), F.max("item_age_hours").alias("item_age_hours")
    )
    picked = rerank.rerank(best, top_k=10)
    return tidy(picked, "user_id", "rank", "news_id", "category", "score")


# Content


@query
def tfidf(spark, folder):
    return tidy(content.tfidf(tables.text_news(spark, folder)))


@query
def cand_content(spark, folder):
    clicks = _events_clicks(spark, folder)
    return tidy(content.content_candidates(clicks, tables.part_news(spark, folder)))


# Pool and recommendations


def _events_pool(spark, folder, users, clicks, items):
    known = users.withColumn("is_cold_start", F.lit(False))
    return pool.candidate_pool(known, clicks, clicks, items, tables.part_news(spark, folder))


def _events_parts(spark, folder):
    return (
        written(_events_tastes(spark, folder)),
        _events_clicks(spark, folder),
        _events_items(spark, folder),
    )


@query
def candidate_pool(spark, folder):
    return tidy(_events_pool(spark, folder, *_events_parts(spark, folder)))


@query
def source_counts(spark, folder):
    rows = _events_pool(spark, folder, *_events_parts(spark, folder))
    return tidy(metrics.source_counts(rows))


@query
def recommend(spark, folder):
    users, clicks, items = _events_parts(spark, folder)
    candidates = written(_events_pool(spark, folder, users, clicks, items))
    scores = popularity.baseline_scores(items)
    asked = tables.requests(spark, folder)
    return tidy(recommending.recommend(asked, users, items, candidates, scores))


# Weights of a linear ranker whose results SQL can follow.
_GIVEN = pairwise.LinearRanker(
    ["ctx_normalized_position", "item_smoothed_ctr", "user_category_share", "user_ctr"],
    [-0.125, 2.0, 0.5, 0.25],
)


@query
def recommend_ranked(spark, folder):
    """Recommendations scored by a ranker on the features it was trained on."""
    log, news = tables.events_log(spark, folder), tables.part_news(spark, folder)
    users = written(user_features.build_user_features(log.withColumn("history_length", F.lit(0)), news))
    items = _events_items(spark, folder)
    asked = tables.requests(spark, folder)
    candidates = written(_events_pool(spark, folder, *_events_parts(spark, folder)))
    table = written(taste_table(clicked(log), news))
    now = log.agg(F.max("timestamp_unix")).first()[0]
    ranked = recommending.recommend(
        asked,
        users,
        items,
        candidates,
        scorer=lambda rows: _GIVEN.score(candidate_features(rows, news, table, now)),
    )
    return tidy(ranked)


@query
def recommend_top_clicks(spark, folder):
    users, items = _events_tastes(spark, folder), _events_items(spark, folder)
    scores = popularity.baseline_scores(items)
    asked = tables.requests(spark, folder)
    return tidy(recommending.recommend(asked, users, items, scores=scores))


@query
def cold_start(spark, folder):
    users, items = _events_tastes(spark, folder), _events_items(spark, folder)
    cold = recommending.route(tables.requests(spark, folder), users).filter("is_cold_start")
    listed = recommending.cold_start_list(items, 10)
    return tidy(recommending.attach(cold, listed, "cold_start_popular", True))


# Models


def _ready_matrix(spark, folder, splits=("train", "val", "test"), inputs=None):
    """Splits of the feature matrix, written once; of the features only ``inputs`` where they are named."""
    matrix = _matrix(spark, folder).drop("title", "abstract").filter(F.col("split").isin(*splits))
    if inputs is not None:
        matrix = matrix.select("impression_id", "user_id", "news_id", "label", "split", *inputs)
    matrix = written(matrix)
    return [matrix.filter(F.col("split") == name) for name in splits]


def _evaluated(scored):
    return metrics.evaluate_ranking(scored.withColumn("score", decimals(F.col("score"), 9)))


@query
def group_sizes(spark, folder):
    return tidy(pairwise.group_sizes(tables.orders_log(spark, folder)))


@query
def pairwise_targets(spark, folder):
    """The rows that stand for all pairs of an impression, summed per target."""
    log = tables.orders_log(spark, folder)
    problem = pairwise.pairwise_problem(log, ["history_length", "timestamp_unix"])
    return tidy(
        problem.groupBy("target").agg(
            F.count("*").alias("rows"),
            F.sum("weight").alias("weight"),
            F.sum(F.col("weight") * F.col("history_length") * F.col("history_length")).alias(
                "moment"
            ),
        )
    )


@query
def pairwise_linear_ranker(spark, folder):
    train, _, test = _ready_matrix(spark, folder)
    return tidy(_evaluated(pairwise.LinearRanker.fit(train).score(test)))


@query
def pairwise_tree_ranker(spark, folder):
    train, val, test = _ready_matrix(spark, folder)
    return tidy(_evaluated(boosting.TreeRanker.fit(train, val).score(test)))


@query
def grid_search(spark, folder):
    """All combinations of the default grid: two sizes each of six models from the same scans."""
    train, val = _ready_matrix(spark, folder, ("train", "val"))
    _, trials = boosting.grid_search(train, val)
    columns = ("max_depth", "learning_rate", "n_estimators", "trees", "ndcg_at_10")
    return tidy(
        spark.createDataFrame(
            [tuple(t[c] for c in columns) for t in trials],
            "max_depth int, learning_rate double, n_estimators int, trees int, ndcg_at_10 double",
        )
    )


@query
def feature_importance(spark, folder):
    train, val = _ready_matrix(spark, folder, ("train", "val"))
    ranker = boosting.TreeRanker.fit(train, val)
    return tidy(attribution.top_features(ranker.importance(spark)))


@query
def mlp_ranker(spark, folder):
    train, val, test = _ready_matrix(spark, folder)
    ranker = neural.NeuralRanker.fit(train, val)
    return tidy(_evaluated(ranker.score(test)))


@query
def model_comparison_fitted(spark, folder):
    """The popularity baseline against fitted tree and neural rankers, on held-out rows."""
    split, news = written(_split_log(spark, folder)), tables.part_news(spark, folder)
    matrix = written(build_matrix(split, news).drop("title", "abstract"))
    train, val, test = [matrix.filter(F.col("split") == name) for name in ("train", "val", "test")]
    tree, network = boosting.TreeRanker.fit(train, val), neural.NeuralRanker.fit(train, val)
    items = item_features.build_item_features(split.filter(F.col("split") == "train"), news)
    scores = written(popularity.baseline_scores(items))
    scorers = {
        "popularity_baseline": lambda df: popularity.lookup_scores(df, scores),
        "tree_ranker": tree.score,
        "neural_ranker": network.score,
    }
    rounded = {
        name: lambda df, f=f: f(df).withColumn("score", decimals(F.col("score"), 9))
        for name, f in scorers.items()
    }
    return tidy(metrics.compare_models(test, rounded))


@query
def recommend_fitted(spark, folder):
    """Recommendations scored by a tree ranker that is fitted on the log's own features."""
    log, news = tables.events_log(spark, folder), tables.part_news(spark, folder)
    past = written(prep.dedup_interactions(log.withColumn("history_length", F.lit(0))))
    matrix = written(build_matrix(prep.time_split(past), news).drop("title", "abstract"))
    train, val = (matrix.filter(F.col("split") == s) for s in ("train", "val"))
    # candidates have no place in a past impression
    known = [c for c in feature_columns(train) if c.startswith(("ctx_hour", "ctx_day", "item_", "user_"))]
    ranker = boosting.TreeRanker.fit(train, val, known)
    users = written(user_features.build_user_features(log.withColumn("history_length", F.lit(0)), news))
    items = _events_items(spark, folder)
    candidates = written(_events_pool(spark, folder, *_events_parts(spark, folder)))
    table = written(taste_table(clicked(log), news))
    now = log.agg(F.max("timestamp_unix")).first()[0]
    ranked = recommending.recommend(
        tables.requests(spark, folder),
        users,
        items,
        candidates,
        scorer=lambda rows: ranker.score(candidate_features(rows, news, table, now)),
    )
    return tidy(ranked)


@query
def attribution_linear(spark, folder):
    train, _, test = _ready_matrix(spark, folder)
    ranker = pairwise.LinearRanker.fit(train)
    return tidy(attribution.linear_attribution(ranker, test))


@query
def attribution_trees(spark, folder):
    """Shapley contributions to the scores of fitted trees, over all held-out rows."""
    train, val, test = _ready_matrix(spark, folder)
    ranker = boosting.TreeRanker.fit(train, val)
    return tidy(tree_attribution(ranker.forest, test))


@query
def attribution_fixed_weights(spark, folder):
    """Contributions to a linear score of given weights, over all held-out rows."""
    ranker = pairwise.LinearRanker(
        ["ctx_impression_size", "item_total_impressions", "user_total_clicks"], [0.5, -0.25, 2.0]
    )
    (test,) = _ready_matrix(spark, folder, ["test"], ranker.features)
    return tidy(attribution.linear_attribution(ranker, test))


@query
def seeded_sample(spark, folder):
    log = prep.dedup_interactions(tables.orders_log(spark, folder))
    sample = attribution.seeded_sample(log, ["impression_id", "news_id"], 1000)
    return tidy(sample, "impression_id", "news_id", "user_id", "label")


@query
def feature_column_names(spark, folder):
    """Model inputs of the feature matrix, with their means."""
    # read once, so it need not be written
    train = tidy(_matrix(spark, folder).drop("title", "abstract").filter(F.col("split") == "train"))
    names = feature_columns(train)
    means = train.agg(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean")) for c in names
    ]).alias("f"))
    return tidy(means.select(F.explode("f").alias("f")).select("f.*"))


def _orders_users(spark, folder):
    log, news = tables.orders_log(spark, folder), tables.part_news(spark, folder)
    return written(user_features.build_user_features(log, news))


@query
def standardised_users(spark, folder):
    users = _orders_users(spark, folder)
    return tidy(segments.standardised_features(users, segments.SEGMENT_FEATURES))


@query
def segment_users(spark, folder):
    users = _orders_users(spark, folder)
    return tidy(segments.Segmentation.fit(users).assign(users), "user_id", "user_cluster")


@query
def cluster_profile(spark, folder):
    users = _orders_users(spark, folder)
    assigned = segments.Segmentation.fit(users).assign(users)
    return tidy(segments.cluster_profile(assigned, segments.SEGMENT_FEATURES))


@query
def group_profile(spark, folder):
    """The cluster profile with the top category as the grouping."""
    users = _orders_users(spark, folder)
    return tidy(segments.cluster_profile(users, segments.SEGMENT_FEATURES, "user_top_category"))

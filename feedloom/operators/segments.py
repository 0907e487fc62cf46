"""User segments by K-means on standardised user features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.operators import kmeans
from feedloom.operators.neural import standardisation

# The user features that segments are built on.
SEGMENT_FEATURES = (
    "user_total_interactions",
    "user_total_clicks",
    "user_ctr",
    "user_unique_items",
    "user_interaction_frequency",
    "user_click_diversity",
    "user_category_diversity",
    "user_subcategory_diversity",
    "user_total_sessions",
    "user_avg_session_size",
    "user_avg_session_clicks",
    "user_history_length",
)


def standardised_features(users: DataFrame, features: Sequence[str]) -> DataFrame:
    """(user_id, feature, z): each feature minus its mean, over its population deviation."""
    stats = users.agg(
        F.struct(*[F.avg(c).alias(f"m_{c}") for c in features]).alias("mean"),
        F.struct(*[F.stddev_pop(c).alias(f"s_{c}") for c in features]).alias("std"),
    ).select(F.struct("mean", "std").alias("s"))
    scaled = users.withColumn("_s", stats.scalar())
    values = [
        F.struct(
            F.lit(c).alias("feature"),
            F.coalesce(
                F.try_divide(
                    F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col("_s.mean")[f"m_{c}"],
                    F.col("_s.std")[f"s_{c}"],
                ),
                F.lit(0.0),
            ).alias("z"),
        )
        for c in features
    ]
    return scaled.select("user_id", F.explode(F.array(*values)).alias("v")).select("user_id", "v.*")


def _features(users: DataFrame, stats: dict) -> list[Column]:
    """Each feature minus its mean, over its deviation; nulls count as 0."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in stats}
    return [(filled[c] - F.lit(mean)) / F.lit(std) for c, (mean, std) in stats.items()]


@dataclass
class Segmentation:
    """A fitted segmentation: centres of standardised features, one in a row."""

    centres: np.ndarray
    stats: dict
    silhouettes: dict[int, float]

    @property
    def n_clusters(self) -> int:
        return len(self.centres)

    @classmethod
    def fit(
        cls,
        users: DataFrame,
        min_k: int = 3,
        max_k: int = 10,
        restarts: int = 10,
        seed: int = 42,
        sample: int = 5000,
    ) -> Segmentation:
        """Choose the number of clusters with the best silhouette, the first of equals.

        All numbers and restarts are fitted by the same scans over all users; of the restarts of a number the
        one with the lowest cost counts. Silhouettes are Euclidean, on ``sample`` users chosen by a hash.
        Without two distinct users there are no clusters.
        """
        names = [c for c in SEGMENT_FEATURES if c in users.columns]
        if len(names) < 3:
            raise ValueError(f"too few segment features: {names}")
        stats = standardisation(users, names)
        points = written(
            users.select(F.xxhash64("user_id").alias("draw"), F.array(*_features(users, stats)).alias("z"))
        )
        starts = kmeans.starting_centres(points, range(min_k, max_k + 1), restarts, seed, len(names))
        centres, costs, _ = kmeans.fitted(points, starts, len(names))
        best = {}
        for model in sorted(centres):
            if model[0] not in best or costs[model] < costs[best[model[0]]]:
                best[model[0]] = model
        # the documented sample
        order = (F.xxhash64("draw", F.lit(seed)), F.col("z"))
        asked = np.array([r["z"] for r in points.orderBy(*order).limit(sample).select("z").collect()])
        models = {k: centres[m] for k, m in best.items() if len(centres[m]) > 1}
        silhouettes = kmeans.silhouettes(users.sparkSession, asked, models)
        # of equal silhouettes the smaller number of clusters
        chosen = min(silhouettes, key=lambda k: (-silhouettes[k], k), default=None)
        return cls(models.get(chosen, np.empty((0, len(names)))), stats, silhouettes)

    def assign(self, users: DataFrame) -> DataFrame:
        """Users with their user_cluster, the nearest centre, the first of equals; null if there are none."""
        if not len(self.centres):
            return users.withColumn("user_cluster", F.lit(None).cast("int"))
        z = F.array(*_features(users, self.stats))
        centres = F.array(*[F.array(*map(F.lit, map(float, c))) for c in self.centres])

        def far(centre: Column) -> Column:
            steps = F.zip_with(z, centre, lambda a, b: (a - b) * (a - b))
            return F.aggregate(steps, F.lit(0.0), lambda upto, step: upto + step)

        ranked = F.transform(centres, lambda centre, i: F.struct(far(centre).alias("far"), i.alias("i")))
        return users.withColumn("user_cluster", F.array_min(ranked)["i"])

    def save(self, spark: SparkSession, users: DataFrame, folder: str) -> None:
        """Centres, scaling, means per cluster as CSV and sizes with silhouettes as JSON."""
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centres)]
        centres = spark.createDataFrame(rows, "user_cluster int, centre array<double>")
        centres.coalesce(1).write.mode("overwrite").parquet(f"{folder}/centres")
        scaling = [(c, mean, std) for c, (mean, std) in self.stats.items()]
        spark.createDataFrame(scaling, "feature string, mean double, std double").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{folder}/scaling")
        profile = cluster_profile(self.assign(users), list(self.stats))
        profile.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/profile")
        tried = spark.createDataFrame(list(self.silhouettes.items()), "k int, silhouette double")
        tried.coalesce(1).write.mode("overwrite").json(f"{folder}/silhouettes")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Segmentation:
        # one row per feature, per cluster and per tried k
        scaling = spark.read.parquet(f"{folder}/scaling").collect()
        order = {c: i for i, c in enumerate(SEGMENT_FEATURES)}
        rows = sorted(scaling, key=lambda x: order[x["feature"]])
        stats = {x["feature"]: (x["mean"], x["std"]) for x in rows}
        centres = sorted(map(tuple, spark.read.parquet(f"{folder}/centres").collect()))
        tried = spark.read.schema("k int, silhouette double").json(f"{folder}/silhouettes").collect()
        return cls(
            np.array([c for _, c in centres]).reshape(-1, len(stats)),
            stats,
            {x["k"]: x["silhouette"] for x in tried},
        )


def cluster_profile(
    assigned: DataFrame, features: Sequence[str], cluster: str = "user_cluster"
) -> DataFrame:
    """Size, share and feature means of each cluster."""
    sizes = assigned.groupBy(cluster).agg(
        F.count("*").alias("users"), *[F.avg(c).alias(c) for c in features]
    )
    total = assigned.agg(F.count("*").alias("n")).scalar()
    return sizes.withColumn("share", F.col("users") / total)

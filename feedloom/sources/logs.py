"""Raw log scans and the Parquet layout of prepared data and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.columns import LOG_TIME_FORMAT, has_text


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column order of the two tab-separated raw files.
NEWS_SCHEMA = _strings(
    "news_id",
    "category",
    "subcategory",
    "title",
    "abstract",
    "url",
    "title_entities",
    "abstract_entities",
)
BEHAVIORS_SCHEMA = _strings("impression_id", "user_id", "timestamp", "history", "impressions")

SPLITS = ("train", "val", "test")
FEATURE_SETS = ("user_features", "item_features", *SPLITS)


def _read_tsv(spark: SparkSession, path, schema: T.StructType, quote: str) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.csv(
        paths, schema=schema, sep="\t", header=False, quote=quote, mode="DROPMALFORMED"
    )


def dedup_news(news: DataFrame) -> DataFrame:
    """One row per news_id; of several, the smallest by its other columns survives."""
    rest = [c for c in news.columns if c != "news_id"]
    kept = news.filter(F.col("news_id").isNotNull()).groupBy("news_id")
    return kept.agg(F.min(F.struct(*rest)).alias("_kept")).select(
        "news_id", *[F.col("_kept")[c].alias(c) for c in rest]
    )


def read_news(spark: SparkSession, path, quote: str = "") -> DataFrame:
    """Catalogue scan: fixed schema, malformed lines and null ids dropped, one row per id.

    Quoting is off by default, since titles hold bare quote characters; pass
    ``quote='"'`` for files written with it.
    """
    return dedup_news(_read_tsv(spark, path, NEWS_SCHEMA, quote))


def parse_log_time(behaviors: DataFrame) -> DataFrame:
    """Text time to timestamp; unreadable times become null."""
    return behaviors.withColumn(
        "timestamp", F.try_to_timestamp(F.col("timestamp"), F.lit(LOG_TIME_FORMAT))
    )


def drop_blank_impressions(behaviors: DataFrame) -> DataFrame:
    return behaviors.filter(has_text(F.col("impressions")))


def read_behaviors(spark: SparkSession, path, quote: str = "") -> DataFrame:
    """Behaviour scan: fixed schema, times parsed, rows without impressions dropped."""
    raw = _read_tsv(spark, path, BEHAVIORS_SCHEMA, quote)
    return parse_log_time(drop_blank_impressions(raw))


def read_dataset(spark: SparkSession, folder: str, quote: str = "") -> dict[str, DataFrame]:
    """Both files of one raw folder."""
    return {
        "news": read_news(spark, f"{folder}/news.tsv", quote),
        "behaviors": read_behaviors(spark, f"{folder}/behaviors.tsv", quote),
    }


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def write_processed(news: DataFrame, interactions: DataFrame, folder: str) -> None:
    """Write the catalogue, and the interactions in one pass with one folder per split."""
    news.write.mode("overwrite").parquet(f"{folder}/news")
    interactions.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/interactions")


def read_processed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The catalogue and the three splits; each split reads only its own folder."""
    whole = spark.read.parquet(f"{folder}/interactions")
    splits = {s: whole.filter(F.col("split") == s).drop("split") for s in SPLITS}
    return {"news": spark.read.parquet(f"{folder}/news"), **splits}


def write_features(features: dict[str, DataFrame], folder: str) -> None:
    for name, frame in features.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_features(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Those feature sets that were written."""
    return {
        name: spark.read.parquet(f"{folder}/{name}")
        for name in FEATURE_SETS
        if path_exists(spark, f"{folder}/{name}")
    }

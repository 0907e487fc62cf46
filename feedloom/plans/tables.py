"""The driver tables read as click logs and catalogues.

orders_log   one row per order line: an order is an impression, a returned line a click
events_log   one row per event: a user's day is an impression, click and purchase are clicks
packed_log   raw behaviour rows with packed text lists, built line by line from the orders log
part_news    the part table as catalogue
text_news    the documents table as catalogue, whole texts as titles
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.columns import LOG_TIME_FORMAT, epoch_seconds


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders_log(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber"
    )
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("impression_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("news_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("o_orderdate").alias("timestamp"),
        (F.col("l_linenumber") - 1).alias("history_length"),
    )
    return rows.withColumn("timestamp_unix", epoch_seconds(rows, "timestamp"))


def events_log(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("ts", "user_id", "event_type", "props")
    rows = events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("news_id"),
        F.col("event_type").isin("click", "purchase").cast("int").alias("label"),
        F.col("ts").alias("timestamp"),
        epoch_seconds(events, "ts").alias("timestamp_unix"),
    )
    day = F.floor(F.col("timestamp_unix") / 86400)
    return rows.withColumn("impression_id", F.col("user_id") * 100_000 + day)


def packed_log(spark: SparkSession, folder: str) -> DataFrame:
    """Behaviour rows as text, bad pieces, blank histories and unreadable times included."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"
    )
    number = F.col("l_linenumber")
    oddity = (
        F.when(number == 3, "bad")
        .when(number == 4, "N1-")
        .when(number == 5, "-1")
        .when(number == 6, F.concat(F.lit("X"), F.col("l_partkey"), F.lit("-0")))
        .otherwise("")
    )
    shown = F.concat(
        F.lit("N"), F.col("l_partkey"), F.lit("-"),
        (F.col("l_returnflag") == "R").cast("int"),
    )
    also = F.concat(
        F.lit("N"), F.col("l_suppkey"), F.lit("-"),
        (F.col("l_linestatus") == "F").cast("int"),
    )
    history = (
        F.when(number == 1, F.lit(None))
        .when(number == 2, " ")
        .otherwise(F.concat(F.lit("N"), F.col("l_partkey"), F.lit(" N"), F.col("l_suppkey")))
    )
    when = F.when(number == 7, "no time").otherwise(F.date_format("o_orderdate", LOG_TIME_FORMAT))
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").cast("string").alias("impression_id"),
        F.concat(F.lit("U"), F.col("o_custkey")).alias("user_id"),
        when.alias("timestamp"),
        history.alias("history"),
        F.concat_ws(" ", shown, oddity, also).alias("impressions"),
    )


def part_news(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("news_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_name", "p_type", "p_brand"))
        .when(F.col("p_size") > 20, " ")
        .alias("abstract"),
    )


def packed_news(spark: SparkSession, folder: str) -> DataFrame:
    """The part catalogue under the text ids of the packed log."""
    news = part_news(spark, folder)
    return news.withColumn("news_id", F.concat(F.lit("N"), F.col("news_id")))


def text_news(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("news_id"),
        F.col("lang").alias("category"),
        F.col("source").alias("subcategory"),
        F.col("text").alias("title"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendation requests: every customer, most of whom the events log does not know."""
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))

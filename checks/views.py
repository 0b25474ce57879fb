"""The given tables in the shapes of the jobs. The same shapes as SQL stand in ``sql.py``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
DOC_FEATURES = ["n_lines", "n_words", "source_length"]
CARD_FEATURES = ["amount", "hour_share"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(key: str, factor: int, modulus: int) -> Column:
    return F.col(key) * factor % modulus


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips: short ways inside one city, a duration that depends on where and when."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 2 + 1).cast("int").alias("vendor_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        _mod("event_id", 7, 9).cast("int").alias("passenger_count"),
        (_mod("user_id", 37, 100) / F.lit(1e3) - 74.05).alias("pickup_longitude"),
        (_mod("user_id", 53, 100) / F.lit(5e2) + 40.6).alias("pickup_latitude"),
        (_mod("event_id", 41, 100) / F.lit(1e3) - 74.05).alias("dropoff_longitude"),
        (_mod("event_id", 29, 100) / F.lit(1e3) + 40.6).alias("dropoff_latitude"),
        F.when(F.col("event_type") == "view", "Y").otherwise("N").alias("store_and_fwd_flag"),
        (F.floor("value") + 9 * _mod("event_id", 41, 100) + 11 * F.hour("ts")).cast("int").alias("trip_duration"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as card payments with a fraud label that follows a logistic law in the amount."""
    chance = 1 / (1 + F.exp(1.5 - F.col("value") / F.lit(5e1)))
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") / F.lit(1e2)).alias("amount"),
        (F.hour("ts") / F.lit(2.4e1)).alias("hour_share"),
        F.when(_mod("event_id", 7919, 1000) / F.lit(1e3) < chance, 1.0).otherwise(0.0).alias("label"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the price in cents as a whole-number label."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *PRICE_FEATURES, F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a 0/1 label (returned), two scaled features, a score and a hard prediction from columns."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity") / F.lit(5e1)).alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("returned"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("guess"),
        F.col("l_extendedprice").alias("score"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with size counts as features and the character count as label."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).alias("n_words"),
        F.length("source").alias("source_length"),
        "lang",
        "n_chars",
    )


def order_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their total and a rule-based guess of it."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_totalprice").alias("label"),
        (F.month("o_orderdate") * F.lit(2e4) + F.col("o_custkey") % 7 * F.lit(3e4)).alias("prediction"),
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two points on the globe per customer."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (_mod("c_custkey", 37, 360) - 180).cast("double").alias("lon1"),
        (_mod("c_custkey", 53, 180) - 90).cast("double").alias("lat1"),
        (_mod("c_custkey", 41, 360) - 180).cast("double").alias("lon2"),
        (_mod("c_custkey", 29, 180) - 90).cast("double").alias("lat2"),
    )

"""Test tables and the derived inputs the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.drift import inject_shift

SHIP_SPLIT = "1998-05-24"  # fixed value: median ship date
EVENT_SPLIT = "2024-01-16"  # fixed value: median event day
DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a number kept as text, blank for low-priority orders."""
    text = F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(
        F.col("o_custkey").cast("string")
    )
    return load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", text.alias("amount")
    )


def lines_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Line items tagged base or new by ship date."""
    side = F.when(F.col("l_shipdate") < moment(SHIP_SPLIT), "base").otherwise("new")
    return load(spark, folder, "lineitem").select(*DRIFT_COLUMNS, side.alias("side"))


def lines_halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Line items before and after the split date, the later ones with a shifted price."""
    lines = load(spark, folder, "lineitem")
    early = lines.where(F.col("l_shipdate") < moment(SHIP_SPLIT))
    late = lines.where(F.col("l_shipdate") >= moment(SHIP_SPLIT))
    shifted = inject_shift(late, "l_quantity", "l_extendedprice", key=LINE_KEY)
    return early.select(*DRIFT_COLUMNS, "l_tax"), shifted.select(*DRIFT_COLUMNS)


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a quality label: key, two numbers, two categories, label."""
    labels = load(spark, folder, "labels")
    documents = load(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source")
    return labels.join(documents, "doc_id").withColumn(
        "n_chars", F.col("n_chars").cast("double")
    )


def ruled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a 0/1 label and a 0/1 prediction made by a rule."""
    return load(spark, folder, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_discount") > 0.03, 1.0).otherwise(0.0).alias("prediction"),
    )

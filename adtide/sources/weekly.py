"""The weekly advertiser CSV and its mapping to media cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the weekly file, and spend column -> channel name.
WEEKLY_SCHEMA = T.StructType(
    [
        T.StructField("DATE", T.DateType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("tv_S", T.DoubleType()),
        T.StructField("ooh_S", T.DoubleType()),
        T.StructField("print_S", T.DoubleType()),
        T.StructField("facebook_I", T.DoubleType()),
        T.StructField("search_clicks_P", T.DoubleType()),
        T.StructField("search_S", T.DoubleType()),
        T.StructField("competitor_sales_B", T.LongType()),
        T.StructField("facebook_S", T.DoubleType()),
        T.StructField("events", T.StringType()),
        T.StructField("newsletter", T.DoubleType()),
    ]
)
CHANNEL_OF_SPEND = {
    "tv_S": "tv",
    "ooh_S": "ooh",
    "print_S": "print",
    "facebook_S": "facebook",
    "search_S": "search",
}


def read_weekly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan; the header is checked against the schema. Order comes from windows, not here."""
    return spark.read.csv(path, schema=WEEKLY_SCHEMA, header=True, enforceSchema=False)


def weekly_cells(weekly: DataFrame, panel_id: str = "advertiser") -> DataFrame:
    """One row per (week, channel). Panel-level measures are carried by the first channel only,
    so that summing the cells of a week gives the panel's value."""
    renamed = weekly.withColumnsRenamed(CHANNEL_OF_SPEND)
    channels = list(CHANNEL_OF_SPEND.values())
    long = renamed.unpivot(
        ["DATE", "revenue", "competitor_sales_B"], channels, "channel", "spend"
    )
    first = F.col("channel") == channels[0]
    return long.select(
        F.lit(panel_id).alias("panel_id"),
        "channel",
        F.col("DATE").alias("week"),
        "spend",
        F.when(first, F.col("revenue")).otherwise(0.0).alias("revenue"),
        F.when(first, F.col("competitor_sales_B").cast("double")).otherwise(0.0).alias("competitor"),
    )

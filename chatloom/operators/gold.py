"""The gold panel: titles attached, and its yearly report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.columns import percentage
from chatloom.operators.panel import drop_key, rename_title


def attach_titles(panel: DataFrame, vods: DataFrame) -> DataFrame:
    """Add ``match_title`` to every panel row, NULL where the catalogue has no such VOD.

    Ids are compared as text, so an odd ``vod_id`` matches nothing instead of failing. Whether
    the catalogue is broadcast is left to the session's threshold and the sizes that Spark knows;
    a larger one is joined by shuffle, where adaptive execution splits a hot VOD.
    """
    titles = vods.select(F.col("id").cast("string").alias("id"), "title")
    joined = panel.join(titles, panel["vod_id"] == titles["id"], "left")
    return rename_title(drop_key(joined))


def records_per_title(panel: DataFrame) -> DataFrame:
    """Panel rows and rows without user, per broadcast title."""
    missing = F.col("i_user_id").isNull() | F.col("i_user_name").isNull()
    return panel.groupBy("match_title").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if(missing).alias("missing_user_count")
    )


def gold_report(panel: DataFrame, years: DataFrame) -> DataFrame:
    """Per requested year: panel rows, rows without user, percentage; zeros for an empty year."""
    missing = F.col("i_user_id").isNull() | F.col("i_user_name").isNull()
    counts = panel.groupBy("year").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("missing")
    )
    filled = years.join(counts, "year", "left").na.fill(0, ["total", "missing"])
    return filled.select(
        "year",
        F.col("total").alias("total_emote_records"),
        F.col("missing").alias("records_missing_user_info"),
        percentage(F.col("missing"), F.col("total")).alias("records_missing_user_info_percentage"),
    ).orderBy("year")

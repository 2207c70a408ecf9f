"""User and colour statistics on the panel, and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def colour_share_rows(panel: DataFrame) -> DataFrame:
    """Share of panel rows with a display colour, 0 to 1."""
    return panel.agg(F.avg(F.col("i_display_color").isNotNull().cast("double")).alias("colour_share"))


def colour_share_users(panel: DataFrame) -> DataFrame:
    """Distinct users, distinct users seen with a colour, and the percentage.

    Grouping by user first merges a user's rows before the shuffle; a row without id is no user.
    """
    users = (
        panel.filter(F.col("i_user_id").isNotNull())
        .groupBy("i_user_id")
        .agg(F.bool_or(F.col("i_display_color").isNotNull()).alias("coloured"))
    )
    counts = users.agg(
        F.count(F.lit(1)).alias("total_users"), F.count_if("coloured").alias("users_with_colour")
    )
    share = 100 * F.col("users_with_colour") / F.nullif(F.col("total_users"), F.lit(0))
    return counts.withColumn("users_with_colour_percentage", share)


def badge_version_counts(panel: DataFrame, sep: str = ", ") -> DataFrame:
    """Rows per combination of badge versions, most frequent first; rows without badges are left out."""
    joined = F.concat_ws(sep, "i_badge_versions")
    return (
        panel.select(joined.alias("i_badge_versions"))
        .filter(F.col("i_badge_versions") != "")
        .groupBy("i_badge_versions")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), "i_badge_versions")
    )


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the highest ``by``; ``ties`` make the choice repeatable."""
    return df.orderBy(F.col(by).desc(), *(F.col(c).asc_nulls_last() for c in ties)).limit(k)

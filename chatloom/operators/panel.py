"""From chat messages to the emote panel, and operations on panel rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.columns import badge_field, micros_to_timestamp, user_status_placeholder
from chatloom.schemas import BADGE_COLUMNS, GOLD, PANEL, PARTITIONS, RENAMED


def with_emotes(chat: DataFrame) -> DataFrame:
    """Messages that have an emote list, empty or not."""
    return chat.filter(F.col("emotes").isNotNull())


def explode_emotes(chat: DataFrame) -> DataFrame:
    """One row per emote use, as column ``emote``; NULL and empty lists give none."""
    return chat.withColumn("emote", F.explode("emotes")).drop("emotes")


def badge_arrays(chat: DataFrame) -> DataFrame:
    """Add the author's badges as three parallel arrays: names, titles, versions."""
    badges = F.col("author.badges")
    fields = ("name", "title", "version")
    return chat.withColumns(
        {column: badge_field(badges, field) for column, field in zip(BADGE_COLUMNS, fields)}
    )


def emote_panel(chat: DataFrame, channel: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The silver panel: one row per emote use.

    ``channel`` names the streamer; without it the column ``channel`` does. ``keep`` passes
    further columns through, such as the partition columns. The badge arrays are built per
    message, before the explode multiplies the rows.
    """
    uses = explode_emotes(badge_arrays(with_emotes(chat)))
    return uses.select(
        F.col("author.id").try_cast("bigint").alias("i_user_id"),
        F.col("author.name").alias("i_user_name"),
        F.col("author.colour").alias("i_display_color"),
        *BADGE_COLUMNS,
        user_status_placeholder().alias("i_user_status"),
        (F.col("channel") if channel is None else F.lit(channel)).alias("j_streamer"),
        F.col("emote.name").alias("k_emote_name"),
        micros_to_timestamp(F.col("timestamp")).alias("t_timestamp"),
        F.col("time_text").alias("t_time_text"),
        F.col("time_in_seconds").try_cast("bigint").alias("t_seconds"),
        F.col("vod_id"),
        F.col("message").alias("chat_message"),
        *keep,
    )


def legacy_panel(chat: DataFrame, streamer: str | None = None) -> DataFrame:
    """The first revision of the panel: ten columns, badges left as structs."""
    return explode_emotes(with_emotes(chat)).select(
        F.col("author.id").alias("i_user_id"),
        F.col("author.name").alias("i_username"),
        F.col("author.colour").alias("i_display_color"),
        F.col("author.badges").alias("i_badges"),
        (F.col("channel") if streamer is None else F.lit(streamer)).alias("j_streamer"),
        F.col("emote.name").alias("k_emote_name"),
        micros_to_timestamp(F.col("timestamp")).alias("t_timestamp"),
        F.col("time_text").alias("t_time_text"),
        F.col("time_in_seconds").alias("t_seconds"),
        F.col("message"),
    )


def missing_users(panel: DataFrame) -> DataFrame:
    """Rows without user id or without user name."""
    return panel.filter(F.col("i_user_id").isNull() | F.col("i_user_name").isNull())


def drop_incomplete(panel: DataFrame, required: Sequence[str] = ("i_user_id", "k_emote_name")) -> DataFrame:
    """Drop rows where a required column is NULL or empty text."""
    filled = panel.na.drop(subset=list(required))
    texts = [c for c in required if isinstance(panel.schema[c].dataType, T.StringType)]
    return reduce(lambda df, c: df.filter(F.col(c) != ""), texts, filled)


def flatten_badges(panel: DataFrame, sep: str = ",") -> DataFrame:
    """Badge arrays to joined text. NULL elements are skipped, a NULL array becomes ``""``."""
    return panel.withColumns({c: F.concat_ws(sep, c) for c in BADGE_COLUMNS})


def select_badge_columns(panel: DataFrame) -> DataFrame:
    """User, time and badges only, so that a Parquet scan reads five columns."""
    return panel.select("i_user_name", "t_timestamp", *BADGE_COLUMNS)


def rename_title(joined: DataFrame) -> DataFrame:
    """The broadcast's title under its panel name."""
    return joined.withColumnRenamed("title", "match_title")


def drop_key(joined: DataFrame) -> DataFrame:
    """Drop the catalogue's id once the title is attached."""
    return joined.drop("id")


def normalize_panel(panel: DataFrame) -> DataFrame:
    """Any panel revision in today's columns; columns a revision lacks are NULL.

    A table that mixes revisions holds old and new name side by side, and the filled one wins.
    """
    target = list(PANEL)
    if "match_title" in panel.columns:
        target.append(GOLD["match_title"])
    old_names = {new: old for old, new in RENAMED.items()}

    def column(field: T.StructField):
        present = [c for c in (field.name, old_names.get(field.name)) if c in panel.columns]
        if not present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        # Ids in the old CSV files are text.
        return F.coalesce(*(F.col(c).try_cast(field.dataType) for c in present)).alias(field.name)

    return panel.select(*map(column, target), *(c for c in PARTITIONS if c in panel.columns))


def union_panels(panels: Sequence[DataFrame]) -> DataFrame:
    """Panels on top of each other, columns matched by name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), panels)


def record_count(panel: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Rows per year, or per any other columns."""
    return panel.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"))

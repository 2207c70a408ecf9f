"""Badges that an old panel stored as the text of a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.schemas import BADGE_COLUMNS

# The tokens of list text: quoted text, a bare word, what stands between them, a quote that nothing closes.
_TOKENS = (
    r"(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    r"""|[A-Za-z_]\w*+|[^'"A-Za-z_]++|['"]"""
)
# Bare words and what JSON calls them.
_BARE = {"None": "null", "True": "true", "False": "false"}


def _as_json(text: Column) -> Column:
    """List text as the JSON it nearly is: bare words renamed, two-digit escapes widened.

    Only words outside quotes are bare; most texts hold none of these words and are left as they are.
    """

    def renamed(token: Column) -> Column:
        value = token
        for word, name in _BARE.items():
            value = F.when(token == word, F.lit(name)).otherwise(value)
        return value

    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    text = F.when(text.rlike("|".join(_BARE)), F.array_join(F.transform(tokens, renamed), "")).otherwise(text)
    return F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\x([0-9a-f]{2})", r"$1\\u00$2")


def legacy_badge_info(panel: DataFrame, sep: str = ", ") -> DataFrame:
    """Replace ``i_badges`` by joined names, titles and versions; ``""`` where it is no list.

    A badge without the field counts as empty text; an explicit None version as ``None``.
    """
    parsed = F.from_json(
        _as_json(F.col("i_badges")),
        "array<map<string,string>>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )

    def joined(field: str, explicit_null: str) -> Column:
        def text(badge: Column) -> Column:
            absent = F.when(F.map_contains_key(badge, field), F.lit(explicit_null)).otherwise(F.lit(""))
            return F.coalesce(badge[field], absent)

        return F.coalesce(F.array_join(F.transform("_badges", text), sep), F.lit(""))

    nulls = {"name": "", "title": "", "version": "None"}
    # The text is parsed in a step of its own, so once and not once per column.
    return panel.withColumn("_badges", parsed).withColumns(
        {column: joined(field, null) for column, (field, null) in zip(BADGE_COLUMNS, nulls.items())}
    ).drop("i_badges", "_badges")


def select_legacy_columns(panel: DataFrame) -> DataFrame:
    """The twelve columns of the second legacy form."""
    return panel.select(
        "i_user_id", "i_username", "i_display_color", *BADGE_COLUMNS, "j_streamer", "k_emote_name",
        "t_timestamp", "t_time_text", "t_seconds", "message",
    )

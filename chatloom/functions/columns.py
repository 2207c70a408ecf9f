"""Column expressions shared by the operators. All are built-in, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The format of a chat file's name, {channel}_{year}_{number}_{vod id}.json, or
# {channel}_{year}_{number}.json in the oldest files.
CHAT_FILE = r"^(.+?)_((?:19|20)\d{2})_(\d+)(?:_(\d+))?\.json$"


def micros_to_timestamp(micros: Column) -> Column:
    """Epoch microseconds to timestamp, by integer arithmetic only."""
    return F.timestamp_micros(micros)


def user_status_placeholder() -> Column:
    """The status column no source fills yet: NULL, but typed."""
    return F.lit(None).cast("string")


def badge_field(badges: Column, field: str) -> Column:
    """One field of every badge as array<string>; NULL badges stay NULL, [] stays [].

    Field access on an array of structs compiles to code; a lambda would not.
    """
    return badges[field].cast("array<string>")


def badge_count(badges: Column) -> Column:
    """Number of badges, -1 where there is no badge list; the same with and without ANSI mode."""
    return F.when(badges.isNull(), F.lit(-1)).otherwise(F.size(badges))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two places; 0 for an empty whole."""
    return F.when(whole > 0, F.round(100 * part / whole, 2)).otherwise(F.lit(0.0))


def safe_title(title: Column, length: int = 50) -> Column:
    """A title fit for a file name: letters, digits, dot, dash and underscore, cut to length."""
    return F.substring(F.regexp_replace(title, r"[^\p{L}\p{N}._-]", "_"), 1, length)


def chat_file_name(path: Column) -> Column:
    """The last part of a path, or the one before if that is a folder holding a broadcast's parts.

    Spark writes such folders as ``<name>.json/part-...`` or ``<key>=<name>.json/part-...``.
    """
    last = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.substring_index(F.when(last.endswith(".json"), last).otherwise(folder), "=", -1)


def chat_file_tokens(name: Column, channels: Sequence[str] = ()) -> Column:
    """Channel, year, number and VOD id (or ``""``) in a chat file's name; else one element.

    A name can be read in several ways where a channel's name ends in a year, or a number looks like one. Of
    the given ``channels`` the longest that fits decides; without any, or for others, the first year in the name.
    """
    if channels:
        quoted = "|".join(rf"\Q{c}\E" for c in sorted(set(channels), key=lambda c: (-len(c), c)))
        known = CHAT_FILE.replace("(.+?)", f"({quoted})", 1)
        name = F.regexp_replace(name, known, "$1/$2/$3/$4")
    return F.split(F.regexp_replace(name, CHAT_FILE, "$1/$2/$3/$4"), "/")


def plain_path(file_path: Column) -> Column:
    """A file's path as listings spell it: scans give it URL-encoded, and local ones with three slashes.

    It is asked of every row, so it takes no pattern, and decodes only what is encoded.
    """
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    decoded = F.when(file_path.contains("%"), decoded).otherwise(file_path)
    local = F.concat(F.lit("file:/"), F.ltrim(F.substring(decoded, 7, 1 << 30), F.lit("/")))
    return F.when(decoded.startswith("file:/"), local).otherwise(decoded)


def may_be_of_years(path: Column, years: Sequence[int]) -> Column:
    """False for no chat file of one of the years: a cheap test of a path, for filters that every row meets."""
    return path.rlike("_(?:%s)_[0-9]" % "|".join(map(str, years))) if years else F.lit(False)

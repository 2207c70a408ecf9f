"""Explicit schemas for every table the library reads or writes.

Nothing is inferred: inference costs an extra pass over the data and changes its mind when a
file happens to hold no emotes or no badges.
"""

from pyspark.sql import types as T

TEXT, LONG, TIME, NUMBER = T.StringType(), T.LongType(), T.TimestampType(), T.DoubleType()
TEXTS = T.ArrayType(TEXT)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types of the data model.
CORRUPT = "_corrupt_record"

BADGE = _struct(name=TEXT, title=TEXT, version=TEXT)
EMOTE = _struct(name=TEXT)
AUTHOR = _struct(id=TEXT, name=TEXT, colour=TEXT, badges=T.ArrayType(BADGE))
CHAT = _struct(
    author=AUTHOR,
    emotes=T.ArrayType(EMOTE),
    timestamp=LONG,
    time_text=TEXT,
    time_in_seconds=NUMBER,
    message=TEXT,
)

VOD = _struct(id=LONG, title=TEXT, created_at=TIME, duration=TEXT, url=TEXT)

PANEL = _struct(
    i_user_id=LONG,
    i_user_name=TEXT,
    i_display_color=TEXT,
    i_badge_names=TEXTS,
    i_badge_titles=TEXTS,
    i_badge_versions=TEXTS,
    i_user_status=TEXT,
    j_streamer=TEXT,
    k_emote_name=TEXT,
    t_timestamp=TIME,
    t_time_text=TEXT,
    t_seconds=LONG,
    vod_id=TEXT,
    chat_message=TEXT,
)
GOLD = T.StructType([*PANEL, T.StructField("match_title", TEXT)])

# The first revision of the panel, kept as CSV: badges as list text, then as joined text.
LEGACY = _struct(
    i_user_id=TEXT,
    i_username=TEXT,
    i_display_color=TEXT,
    i_badges=TEXT,
    j_streamer=TEXT,
    k_emote_name=TEXT,
    t_timestamp=TIME,
    t_time_text=TEXT,
    t_seconds=NUMBER,
    message=TEXT,
)
LEGACY_FLAT = _struct(
    i_user_id=TEXT,
    i_username=TEXT,
    i_display_color=TEXT,
    i_badge_names=TEXT,
    i_badge_titles=TEXT,
    i_badge_versions=TEXT,
    j_streamer=TEXT,
    k_emote_name=TEXT,
    t_timestamp=TIME,
    t_time_text=TEXT,
    t_seconds=NUMBER,
    message=TEXT,
)

# What became of each file that the incremental ingest has taken up.
LEDGER = _struct(
    path=TEXT,
    file_name=TEXT,
    channel=TEXT,
    year=T.IntegerType(),
    file_seq=LONG,
    vod_id=TEXT,
    length=LONG,
    modified=TIME,
    status=TEXT,
    message_rows=LONG,
    emote_rows=LONG,
    missing_user_rows=LONG,
    recorded=TIME,
)

BADGE_COLUMNS = ["i_badge_names", "i_badge_titles", "i_badge_versions"]
PARTITIONS = ["channel", "year"]

# Quotes are doubled inside text, and timestamps keep their microseconds.
CSV = {"header": True, "escape": '"', "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# The exact form: NULL apart from empty text, and blanks at the edges of a text.
EXACT_CSV = {**CSV, "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# Column names of earlier panel revisions and the current name of each.
RENAMED = {"i_username": "i_user_name", "message": "chat_message"}

# Headings of the report tables as readers of the CSV files know them.
REPORT_LABELS = {
    "year": "Year",
    "total_files": "Total S3 Files",
    "processed_files": "Processed Files",
    "unprocessed_files": "Unprocessed Files",
    "no_emote_files": "No Emote Files",
    "failed_files": "Failed Files",
    "pending_files": "Pending Files",
    "missing_user_files": "Missing User Files",
    "total_emote_records": "Total Emote Records",
    "records_missing_user_info": "Records Missing User_info",
    "records_missing_user_info_percentage": "Records Missing User_info Percentage",
}


def partitioned(schema: T.StructType) -> T.StructType:
    """The schema of a table stored under ``channel=.../year=...`` folders."""
    return T.StructType([*schema, T.StructField("channel", TEXT), T.StructField("year", T.IntegerType())])

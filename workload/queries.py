"""One registered query per operator, each over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions import micros_to_timestamp, safe_title, user_status_placeholder, year_frame
from chatloom.operators import audit, badges, catalog, gold, legacy, panel, users
from chatloom.plans import badge_report, build_gold, build_silver, migrate_silver
from chatloom.schemas import BADGE_COLUMNS, PARTITIONS, RENAMED
from chatloom.session import configure, scratch_dir
from chatloom.sinks import (
    inspect,
    register_views,
    write_gold_csv,
    write_gold_parquet,
    write_legacy_csv,
    write_report,
    write_silver,
)
from chatloom.sources import (
    broken_files,
    is_blank,
    list_raw_files,
    read_catalog,
    read_chat,
    read_gold,
    read_gold_csv,
    read_ledger,
    read_legacy_panel,
    read_silver,
    with_file_metadata,
)
from chatloom.storage import Storage
from chatloom.streaming import ingest_stream
from workload import adapter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHANNEL = "middle_east"


def query(run: Query) -> Query:
    """Register a query; its result has no arrays and no zoned timestamps."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(run(configure(spark), sf_dir))

    QUERIES[run.__name__] = prepared
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Arrays as joined text (NULL stays NULL) and timestamps in UTC without zone."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, ",").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*map(column, df.schema))


def chat_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.messages(spark, sf_dir)


def panel_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.emote_panel(chat_of(spark, sf_dir), keep=PARTITIONS)


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.attach_titles(panel_of(spark, sf_dir), adapter.catalog(spark, sf_dir))


def counted_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return badges.with_badge_count(panel.select_badge_columns(panel_of(spark, sf_dir)))


def per_user_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return badges.max_badges_per_user(badges.clean_badge_count(counted_of(spark, sf_dir)))


def landed_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_file_metadata(read_chat(spark, adapter.landed(spark, sf_dir)))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_raw_files(spark, adapter.landed(spark, sf_dir))


def status_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, chat = landed_files(spark, sf_dir), read_chat(spark, adapter.landed(spark, sf_dir))
    return audit.file_status(files, with_file_metadata(chat), with_file_metadata(broken_files(chat)))


def years_of(spark: SparkSession) -> DataFrame:
    return year_frame(spark, adapter.YEARS)


# Sources


def chat_rows(chat: DataFrame) -> DataFrame:
    author = F.col("author")
    return with_file_metadata(chat).select(
        "channel", "year", "vod_id",
        author["id"].alias("author_id"), author["name"].alias("author_name"), author["colour"].alias("colour"),
        F.col("author.badges.name").alias("badge_names"),
        F.col("author.badges.title").alias("badge_titles"),
        F.col("author.badges.version").alias("badge_versions"),
        F.col("emotes.name").alias("emote_names"),
        "timestamp", "time_text", "time_in_seconds", "message",
        is_blank().cast("int").alias("blank"),
    )


@query
def read_chat_files(spark, sf_dir):
    return chat_rows(read_chat(spark, adapter.landed(spark, sf_dir)))


@query
def read_chat_split(spark, sf_dir):
    rows = scratch_dir(spark, "split-rows")
    for path in adapter.landed_shares(spark, sf_dir):
        work = scratch_dir(spark, "split-work")
        chat_rows(read_chat(spark, path, split_bytes=64 << 10, work_path=work)).write.mode("append").parquet(rows)
        Storage(spark, work).delete()
    return spark.read.parquet(rows)


@query
def read_vod_catalog(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    adapter.catalog(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return read_catalog(spark, path)


@query
def read_silver_panel(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    write_silver(panel_of(spark, sf_dir), path)
    return read_silver(spark, path, CHANNEL, adapter.YEARS)


@query
def read_silver_mixed_revisions(spark, sf_dir):
    path = scratch_dir(spark, "mixed")
    rows = panel_of(spark, sf_dir)
    old_names = {new: old for old, new in RENAMED.items()}
    rows.filter("year % 2 = 0").write.partitionBy(*PARTITIONS).parquet(path)
    rows.filter("year % 2 = 1").withColumnsRenamed(old_names).write.mode("append").partitionBy(*PARTITIONS).parquet(path)
    return read_silver(spark, path)


@query
def migrate_silver_table(spark, sf_dir):
    old, new = scratch_dir(spark, "old"), scratch_dir(spark, "silver")
    rows = panel_of(spark, sf_dir)
    adapter.write_first_layouts(rows, old)
    migrate_silver(spark, old, new)
    return read_silver(spark, new)


@query
def read_gold_panel(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    write_gold_parquet(gold_of(spark, sf_dir), path)
    return read_gold(spark, path, years=adapter.YEARS)


@query
def read_legacy_csv(spark, sf_dir):
    path = scratch_dir(spark, "legacy")
    old = adapter.badge_text(panel.legacy_panel(chat_of(spark, sf_dir)))
    write_legacy_csv(old, path)
    return read_legacy_panel(spark, path)


@query
def file_metadata(spark, sf_dir):
    columns = ["file_name", "channel", "year", "file_seq", "vod_id"]
    return landed_chat(spark, sf_dir).groupBy(*columns).agg(F.count(F.lit(1)).alias("scanned_rows"))


@query
def raw_file_listing(spark, sf_dir):
    return landed_files(spark, sf_dir).select(
        "file_name", "channel", "year", "file_seq", "vod_id",
        (F.col("parts") > 0).cast("int").alias("has_parts"), (F.col("bytes") > 0).cast("int").alias("has_bytes"),
    )


# Sinks


@query
def write_silver_twice(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    rows = panel_of(spark, sf_dir)
    write_silver(rows, path)
    edited = F.concat(F.lit("edited "), F.col("chat_message"))
    write_silver(rows.filter("vod_id = '21' and k_emote_name is not null").withColumn("chat_message", edited), path)
    return read_silver(spark, path).groupBy("channel", "year", "vod_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("chat_message").startswith("edited ")).alias("edited_count"),
    )


@query
def write_silver_by_year(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    write_silver(panel_of(spark, sf_dir), path, buckets=1)
    return read_silver(spark, path)


@query
def write_gold_as_parquet(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    write_gold_parquet(gold_of(spark, sf_dir), path, files=8)
    return panel.record_count(read_gold(spark, path), ["channel", "year", "match_title"])


@query
def write_gold_as_csv(spark, sf_dir):
    path = scratch_dir(spark, "gold-csv")
    write_gold_csv(gold_of(spark, sf_dir), path)
    written = spark.read.option("header", True).option("escape", '"').csv(path)
    return written.select(
        F.col("i_user_id").cast("bigint"), "i_user_name", *BADGE_COLUMNS, "k_emote_name", "match_title",
        "vod_id", "channel", F.col("year").cast("int"),
    )


@query
def write_gold_as_exact_csv(spark, sf_dir):
    path = scratch_dir(spark, "gold-csv")
    broken_line = F.concat("chat_message", F.lit('\r\n a, "b" \\N'))
    write_gold_csv(gold_of(spark, sf_dir).withColumn("chat_message", broken_line), path, exact=True)
    return read_gold_csv(spark, path)


@query
def write_badge_report(spark, sf_dir):
    path = scratch_dir(spark, "report")
    write_report(badge_report(panel_of(spark, sf_dir)), path)
    schema = "number_of_badges_per_user int, users_volume_count bigint, users_volume_percentage double"
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def write_legacy_panel(spark, sf_dir):
    path = scratch_dir(spark, "legacy")
    flat = panel.emote_panel(chat_of(spark, sf_dir)).withColumnsRenamed(
        {"i_user_name": "i_username", "chat_message": "message"}
    )
    write_legacy_csv(legacy.select_legacy_columns(flat), path)
    return read_legacy_panel(spark, path, flat_badges=True)


@query
def register_view(spark, sf_dir):
    register_views(adapter.catalog(spark, sf_dir), "vod")
    return spark.sql("SELECT duration, count(*) AS vods, max(created_at) AS latest FROM vod GROUP BY duration")


@query
def inspect_table(spark, sf_dir):
    seen = inspect(panel.emote_panel(chat_of(spark, sf_dir)), 5)
    return seen.head.agg(
        F.lit(len(seen.schema)).alias("column_count"),
        F.lit(seen.rows).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("head_count"),
    )


# Projections and filters


@query
def with_emotes(spark, sf_dir):
    return panel.with_emotes(chat_of(spark, sf_dir)).select(
        "vod_id", "timestamp", "message", F.size("emotes").alias("emote_count")
    )


@query
def explode_emotes(spark, sf_dir):
    return panel.explode_emotes(chat_of(spark, sf_dir)).select(
        "vod_id", "timestamp", F.col("author.id").alias("author_id"), F.col("emote.name").alias("emote_name")
    )


@query
def badge_arrays(spark, sf_dir):
    return panel.badge_arrays(chat_of(spark, sf_dir)).select("vod_id", "timestamp", *BADGE_COLUMNS)


@query
def emote_panel(spark, sf_dir):
    return panel.emote_panel(chat_of(spark, sf_dir))


@query
def legacy_panel(spark, sf_dir):
    def spelled(badge):
        return F.concat_ws("/", F.coalesce(badge["name"], F.lit("-")), F.coalesce(badge["title"], F.lit("-")), badge["version"])

    old = panel.legacy_panel(chat_of(spark, sf_dir))
    return old.withColumn("i_badges", F.transform("i_badges", spelled))


@query
def micros_as_timestamp(spark, sf_dir):
    return chat_of(spark, sf_dir).select("timestamp", micros_to_timestamp(F.col("timestamp")).alias("t_timestamp"))


@query
def user_status(spark, sf_dir):
    return (
        chat_of(spark, sf_dir)
        .groupBy(user_status_placeholder().alias("i_user_status"))
        .agg(F.count(F.lit(1)).alias("message_count"))
    )


@query
def missing_users(spark, sf_dir):
    return panel.missing_users(panel_of(spark, sf_dir)).select(
        "i_user_id", "i_user_name", "k_emote_name", "t_timestamp", "vod_id"
    )


@query
def drop_incomplete(spark, sf_dir):
    return panel.drop_incomplete(panel_of(spark, sf_dir)).select("i_user_id", "k_emote_name", "t_timestamp", "vod_id")


@query
def flatten_badges(spark, sf_dir):
    return panel.flatten_badges(panel_of(spark, sf_dir)).select("vod_id", "t_timestamp", *BADGE_COLUMNS)


@query
def legacy_badge_info(spark, sf_dir):
    old = adapter.badge_text(panel.legacy_panel(chat_of(spark, sf_dir)))
    return legacy.select_legacy_columns(legacy.legacy_badge_info(old))


@query
def select_badge_columns(spark, sf_dir):
    return panel.select_badge_columns(panel_of(spark, sf_dir))


@query
def badge_count(spark, sf_dir):
    counted = counted_of(spark, sf_dir)
    return badges.with_badge_count(counted.withColumnRenamed("badges_count", "raw_count"), missing=0).select(
        "i_user_name", "t_timestamp", "raw_count", "badges_count"
    )


@query
def clean_badge_count(spark, sf_dir):
    return badges.clean_badge_count(counted_of(spark, sf_dir)).select(
        "i_user_name", "t_timestamp", "badges_count", "badges_count_tf"
    )


@query
def users_with_badges_over(spark, sf_dir):
    return badges.users_with_badges_over(chat_of(spark, sf_dir), 2)


@query
def search_titles(spark, sf_dir):
    return catalog.search_titles(adapter.catalog(spark, sf_dir), "BOLT", by_date=True).select("title", "created_at")


@query
def search_titles_by_case(spark, sf_dir):
    return catalog.search_titles(adapter.catalog(spark, sf_dir), "ECONOMY", case_sensitive=True)


@query
def vods_of_year(spark, sf_dir):
    return catalog.vods_of_year(adapter.catalog(spark, sf_dir), 2020)


@query
def rename_title_drop_key(spark, sf_dir):
    return panel.rename_title(panel.drop_key(adapter.catalog(spark, sf_dir)))


@query
def normalize_panel(spark, sf_dir):
    return panel.normalize_panel(adapter.old_panel(spark, sf_dir))


@query
def safe_titles(spark, sf_dir):
    return adapter.catalog(spark, sf_dir).select("id", safe_title(F.col("title")).alias("safe_title"))


# Joins


@query
def attach_titles(spark, sf_dir):
    return gold_of(spark, sf_dir).select("vod_id", "i_user_id", "k_emote_name", "t_timestamp", "match_title")


@query
def records_per_title(spark, sf_dir):
    return gold.records_per_title(gold_of(spark, sf_dir))


@query
def badges_of_users_without_badges(spark, sf_dir):
    return badges.badges_of_users_without_badges(counted_of(spark, sf_dir), k=10)


@query
def badges_of_users_or_not(spark, sf_dir):
    return badges.badges_of_users_or_not(counted_of(spark, sf_dir), "Customer#000000003", k=10)


@query
def badge_distribution_subquery(spark, sf_dir):
    return badges.badge_distribution_subquery(per_user_of(spark, sf_dir))


@query
def missing_raw_files(spark, sf_dir):
    return catalog.missing_raw_files(adapter.catalog(spark, sf_dir), landed_files(spark, sf_dir))


# Aggregations


@query
def record_count(spark, sf_dir):
    return panel.record_count(panel_of(spark, sf_dir))


@query
def vods_per_year(spark, sf_dir):
    return catalog.vods_per_year(adapter.catalog(spark, sf_dir))


@query
def max_badges_per_user(spark, sf_dir):
    return per_user_of(spark, sf_dir)


@query
def badge_distribution(spark, sf_dir):
    return badge_report(panel_of(spark, sf_dir))


@query
def badge_name_frequency(spark, sf_dir):
    return badges.badge_name_frequency(panel_of(spark, sf_dir))


@query
def badge_name_frequency_cross(spark, sf_dir):
    return badges.badge_name_frequency(panel_of(spark, sf_dir), mode="cross")


@query
def badge_title_frequency(spark, sf_dir):
    return badges.badge_title_frequency(panel_of(spark, sf_dir))


@query
def badge_title_frequency_cross(spark, sf_dir):
    return badges.badge_title_frequency(panel_of(spark, sf_dir), mode="cross")


@query
def distinct_badges(spark, sf_dir):
    return badges.distinct_badges(panel_of(spark, sf_dir))


@query
def colour_share_rows(spark, sf_dir):
    return users.colour_share_rows(panel_of(spark, sf_dir))


@query
def colour_share_users(spark, sf_dir):
    return users.colour_share_users(panel_of(spark, sf_dir))


@query
def badge_version_counts(spark, sf_dir):
    return users.badge_version_counts(panel_of(spark, sf_dir))


@query
def gold_report(spark, sf_dir):
    return gold.gold_report(panel_of(spark, sf_dir), years_of(spark))


@query
def ingest_report(spark, sf_dir):
    return audit.ingest_report(status_of(spark, sf_dir), years_of(spark))


@query
def file_status(spark, sf_dir):
    return status_of(spark, sf_dir).select(
        "file_name", "channel", "year", "file_seq", "vod_id",
        "message_rows", "emote_rows", "missing_user_rows", "status",
    )


@query
def files_with_status(spark, sf_dir):
    return audit.files_with_status(status_of(spark, sf_dir))


@query
def download_report(spark, sf_dir):
    return catalog.download_report(adapter.catalog(spark, sf_dir), landed_files(spark, sf_dir), years_of(spark))


# Windows, sorts, set operations


@query
def download_manifest(spark, sf_dir):
    return catalog.download_manifest(adapter.catalog(spark, sf_dir), CHANNEL, years_of(spark))


@query
def day_number(spark, sf_dir):
    return catalog.day_number(landed_files(spark, sf_dir)).select("file_name", "file_seq", "day_number")


@query
def order_files(spark, sf_dir):
    return catalog.order_files(landed_files(spark, sf_dir)).select("channel", "year", "file_seq", "file_name")


@query
def sort_vods(spark, sf_dir):
    return catalog.sort_vods(adapter.catalog(spark, sf_dir)).select("created_at", "id")


@query
def top_k(spark, sf_dir):
    counts = badges.badge_name_frequency(panel_of(spark, sf_dir))
    return users.top_k(counts, "tot_count", 2, ties=["badge_names"])


@query
def union_panels(spark, sf_dir):
    both = panel.union_panels(
        [panel.emote_panel(chat_of(spark, sf_dir)), panel.normalize_panel(adapter.old_panel(spark, sf_dir))]
    )
    return both.groupBy("j_streamer", "k_emote_name").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count("vod_id").alias("with_vod"),
        F.sum("t_seconds").alias("seconds"),
    )


@query
def distinct_users(spark, sf_dir):
    return badges.distinct_users(panel_of(spark, sf_dir))


# Streaming and whole jobs


@query
def ingest_chat_stream(spark, sf_dir):
    out = scratch_dir(spark, "stream")
    run = ingest_stream(spark, adapter.landed(spark, sf_dir), out, scratch_dir(spark, "stream-checkpoint"))
    run.awaitTermination()
    return read_silver(spark, out, streamed=True)


@query
def ingest_stream_failures(spark, sf_dir):
    out = scratch_dir(spark, "stream")
    run = ingest_stream(spark, adapter.landed(spark, sf_dir), out, scratch_dir(spark, "stream-checkpoint"))
    run.awaitTermination()
    counts = ["message_rows", "emote_rows", "missing_user_rows"]
    files = read_ledger(spark, out).groupBy("file_name", "channel", "year", "file_seq", "vod_id").agg(
        F.bool_or(F.col("status") == "failed").alias("failed"), *(F.sum(c).alias(c) for c in counts)
    )
    status = F.when(F.col("failed"), "failed").when(F.col("emote_rows") > 0, "processed").otherwise("no_emote")
    return files.withColumn("status", status).drop("failed")


@query
def silver_job(spark, sf_dir):
    report, _ = build_silver(
        spark, adapter.landed(spark, sf_dir), scratch_dir(spark, "staged"), scratch_dir(spark, "silver"), adapter.YEARS
    )
    return report


@query
def gold_job(spark, sf_dir):
    silver, out = scratch_dir(spark, "silver"), scratch_dir(spark, "gold")
    write_silver(panel_of(spark, sf_dir), silver)
    vods = adapter.catalog(spark, sf_dir)
    return build_gold(spark, silver, vods, out, CHANNEL, adapter.YEARS, csv_path=scratch_dir(spark, "gold-csv"))

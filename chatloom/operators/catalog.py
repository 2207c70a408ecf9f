"""Operations on the catalogue of broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.frames import numbered
from chatloom.session import scratch_dir


def search_titles(vods: DataFrame, text: str, case_sensitive: bool = False, by_date: bool = False) -> DataFrame:
    """Broadcasts whose title contains ``text``."""
    title = F.col("title") if case_sensitive else F.lower("title")
    found = vods.filter(title.contains(text if case_sensitive else text.lower()))
    return sort_vods(found) if by_date else found


def vods_of_year(vods: DataFrame, year: int) -> DataFrame:
    """Id and title of the broadcasts of one year."""
    return vods.filter(F.year("created_at") == year).select("id", "title")


def vods_per_year(vods: DataFrame) -> DataFrame:
    """Broadcasts per year of creation, in order."""
    return vods.groupBy(F.year("created_at").alias("year")).agg(F.count(F.lit(1)).alias("vods")).orderBy("year")


def sort_vods(vods: DataFrame) -> DataFrame:
    """Broadcasts by time of creation."""
    return vods.orderBy("created_at", "id")


def order_files(files: DataFrame) -> DataFrame:
    """Files by the number in their name, numerically."""
    return files.orderBy("channel", "year", "file_seq", "file_name")


def day_number(files: DataFrame) -> DataFrame:
    """1-based position of each file's number among the numbers of its channel and year.

    The files are stored first: a listing would ask the file system for every file each time it is used.
    """
    spark, keys = files.sparkSession, ["channel", "year", "file_seq"]
    path = scratch_dir(spark, "day-number-files")
    files.write.parquet(path)
    files = spark.read.schema(files.schema).parquet(path)
    thousands = F.expr("file_seq div 1000")
    numbers = numbered(
        files.select(*keys).distinct(), "day_number", ["channel", "year"], [thousands], ["file_seq"]
    )
    return files.join(numbers, keys)


def _with_file_numbers(vods: DataFrame) -> DataFrame:
    """Broadcasts with ``year`` and ``file_number``, counted from 0 by time within the year."""
    # A year is cut into hours, and a crowded hour further by instant and by ranges of ids.
    hour = F.date_trunc("hour", "created_at")
    ids = F.struct("created_at", F.expr("id div 1000"))
    dated = vods.withColumn("year", F.year("created_at"))
    return numbered(dated, "file_number", ["year"], [hour, ids], ["created_at", "id"], start=0)


def download_manifest(vods: DataFrame, channel: str, years: DataFrame, root: str = "raw_bronze") -> DataFrame:
    """What to fetch: per year, broadcasts numbered from 0 by time, with target name and key."""
    wanted = vods.join(years, F.year("created_at") == years["year"], "left_semi")
    manifest = _with_file_numbers(wanted)
    name = F.format_string(f"{channel}_%d_%03d_%d.json", "year", "file_number", "id")
    return manifest.withColumn("file_name", name).select(
        "year",
        "file_number",
        F.col("id").cast("string").alias("vod_id"),
        "title",
        "url",
        "file_name",
        F.concat_ws("/", F.lit(root), F.lit(channel), F.col("year"), F.col("file_name")).alias("key"),
    )


def _by_key(vods: DataFrame, files: DataFrame, channel: str | None) -> DataFrame:
    """Broadcasts with ``landed``: whether a file is theirs, by VOD id or, in a name of the oldest form, by
    year and number. A broadcast asks for both keys, a file has one."""
    by_id = lambda vod: F.concat(F.lit("vod "), vod)
    by_number = lambda year, number: F.concat_ws(" ", F.lit("number"), year, number)
    wanted = _with_file_numbers(vods).select("year", F.col("id").cast("string").alias("vod_id"), "title", "file_number")
    asked = wanted.withColumn("key", F.explode(F.array(by_id(F.col("vod_id")), by_number(F.col("year"), F.col("file_number")))))
    old = F.col("vod_id").isNull()
    if channel is not None:
        files = files.filter(~old | (F.col("channel") == channel))
    key = F.when(old, by_number(F.col("year"), F.col("file_seq"))).otherwise(by_id(F.col("vod_id")))
    found = files.select(key.alias("key")).distinct().withColumn("landed", F.lit(True))
    return asked.join(found, "key", "left").groupBy(*wanted.columns).agg(F.coalesce(F.bool_or("landed"), F.lit(False)).alias("landed"))


def missing_raw_files(vods: DataFrame, files: DataFrame, channel: str | None = None) -> DataFrame:
    """Broadcasts without a landed chat file: year, VOD id and title.

    A file without VOD id in its name is the broadcast of that number in the download manifest of its
    year. With ``channel``, the catalogue's, only such files of this channel count.
    """
    return _by_key(vods, files, channel).filter(~F.col("landed")).select("year", "vod_id", "title")


def download_report(vods: DataFrame, files: DataFrame, years: DataFrame, channel: str | None = None) -> DataFrame:
    """Per requested year: broadcasts wanted, present and missing.

    The missing ones themselves are the rows of :func:`missing_raw_files`.
    """
    counts = _by_key(vods, files, channel).groupBy("year").agg(
        F.count(F.lit(1)).alias("vods_wanted"), F.count_if("landed").alias("vods_present")
    )
    return (
        years.join(counts, "year", "left")
        .na.fill(0, ["vods_wanted", "vods_present"])
        .withColumn("vods_missing", F.col("vods_wanted") - F.col("vods_present"))
        .orderBy("year")
    )

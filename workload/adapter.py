"""Chat-shaped views of the driver's tables.

A message is a ``lineitem`` row; its author is the order's customer; its emotes follow from the
row itself, so no list is ever collected. A broadcast (VOD) is a ``part`` row and takes the
messages of 140 consecutive order keys. All rules are plain arithmetic that SQL can repeat:
``workload/oracles.py`` states them a second time, from the flat tables.
"""

from __future__ import annotations

import gzip
import math
import os
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatloom.session import scratch_dir
from chatloom.storage import Storage

# Fixed values of the mapping, shared with the SQL side.
ORDERS_PER_VOD = 140
VOD_STEP = 21
FIRST_DAY = 1356998400  # 2013-01-01 00:00:00 UTC
DAYS = 4748  # up to 2025-12-31
YEARS = list(range(2012, 2027))  # no broadcast of the tables falls into the first and the last

# Chat files with the awkward contents a landing zone holds: name and text of each.
EDGE_FILES = [
    ("edge_case_2019_001_900000000001.json", "[]"),
    ("edge_case_2019_002_900000000002.json", '[{"author": {"id": "1", "name": "a"}, "emotes": [{"na'),
    (
        "edge_case_2019_003_900000000003.json",
        '[{"author": {"id": "1", "name": "a", "badges": []}, "emotes": [], "timestamp": 1, "message": "m"}]',
    ),
    (
        "edge_case_2012_7.json",
        '[{"author": {"name": "b", "badges": []}, "emotes": [{"name": "e"}, {"name": "f"}], '
        '"timestamp": 1325376000000001, "time_text": "0:01", "time_in_seconds": 1.5, "message": "e f"}]',
    ),
    # A name of the oldest form: the broadcast of this number in its year's manifest, here one of the catalogue.
    ("edge_case_2015_3.json", "[]"),
]


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables. Its schema is read from the footer once, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _vod_seconds(vod: Column) -> Column:
    return F.lit(FIRST_DAY) + (vod * 7919 % DAYS) * 86400 + vod % 86400


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The VOD catalogue: every ``part`` row."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat_ws("", "p_name", F.lit(', "'), "p_brand", F.lit('" - '), "p_type").alias("title"),
        F.timestamp_seconds(_vod_seconds(F.col("p_partkey"))).alias("created_at"),
        F.format_string("%dh%dm%ds", F.col("p_size") % 12, F.col("p_size"), F.col("p_partkey") % 60).alias("duration"),
        F.concat(F.lit("https://videos.example/"), F.col("p_partkey")).alias("url"),
    )


def _badges(key: Column) -> Column:
    names = [F.lit("subscriber"), F.when(key % 31 != 0, F.lit("premium")), F.lit("moderator")]
    titles = [F.lit("Subscriber"), F.lit("Fan, None, True"), F.when(key % 29 != 0, F.lit("Moderator"))]
    badges = [
        F.struct(n.alias("name"), t.alias("title"), (key % 12 + i).cast("string").alias("version"))
        for i, (n, t) in enumerate(zip(names, titles))
    ]
    return F.when(key % 5 != 0, F.slice(F.array(*badges), 1, (key % 4).cast("int")))


def _author() -> Column:
    key = F.col("c_custkey")
    return F.struct(
        F.when(key % 37 == 0, F.lit(None))
        .when(key % 43 == 0, F.concat(F.lit("guest-"), key))
        .otherwise(key.cast("string"))
        .alias("id"),
        F.when(key % 41 != 0, F.col("c_name")).alias("name"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("colour"),
        _badges(key).alias("badges"),
    )


def _emotes() -> Column:
    line = F.col("l_linenumber")
    third = F.when(line == 7, F.lit(None)).when(line == 6, F.lit("")).otherwise(F.col("p_name"))
    uses = F.array(*(F.struct(name.alias("name")) for name in (F.col("p_brand"), F.col("p_type"), third)))
    count = F.expr("cast(cast(l_quantity as int) div 13 as int)")
    return F.when(F.col("l_returnflag") != "R", F.slice(uses, 1, count))


def _of_share(key: str, share: tuple[int, int]) -> Column:
    number, shares = share
    return F.expr(f"pmod({key} div {ORDERS_PER_VOD}, {shares}) = {number}") if shares > 1 else F.lit(True)


def messages(spark: SparkSession, sf_dir: str, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Chat messages, with channel, year and VOD id as columns; of every n-th broadcast if ``share`` is (i, n)."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_returnflag", "l_shipdate"
    ).filter(_of_share("l_orderkey", share))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(_of_share("o_orderkey", share))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey"), F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("channel")
    )
    vod = F.expr(f"(l_orderkey div {ORDERS_PER_VOD}) * {VOD_STEP}")
    seconds = F.col("l_orderkey") % 36000
    micros = (
        F.unix_micros(F.col("l_shipdate").cast("timestamp"))
        + F.col("l_orderkey") % 86400 * 1_000_000
        + F.col("l_partkey") % 1000
    )
    # Orders meet customers and lines meet parts first, so that lines move twice, not three times.
    authored = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    joined = (
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
        .join(authored, lines["l_orderkey"] == authored["o_orderkey"])
        .join(regions, vod % 5 == regions["r_regionkey"])
    )
    return joined.select(
        _author().alias("author"),
        _emotes().alias("emotes"),
        micros.alias("timestamp"),
        F.format_string("%d:%02d:%02d", F.expr("l_orderkey % 36000 div 3600"), F.expr("l_orderkey % 3600 div 60"), F.col("l_orderkey") % 60).alias("time_text"),
        seconds.cast("double").alias("time_in_seconds"),
        F.col("p_name").alias("message"),
        "channel",
        F.year(F.timestamp_seconds(_vod_seconds(vod))).alias("year"),
        vod.cast("string").alias("vod_id"),
    )


def old_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel in the oldest column names, from the ``events`` stream."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        user.cast("string").alias("i_user_id"),
        F.concat(F.lit("viewer_"), user).alias("i_username"),
        F.lit("events").alias("j_streamer"),
        F.col("event_type").alias("k_emote_name"),
        F.col("ts").cast("timestamp").alias("t_timestamp"),
        F.col("value").alias("t_seconds"),
        F.col("props").alias("message"),
    )


def badge_text(legacy: DataFrame) -> DataFrame:
    """The legacy panel with its badges as the text of a list, as a CSV of it holds them."""

    def quoted(text: Column) -> Column:
        return F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("None"))

    def one(badge: Column) -> Column:
        fields = [F.concat(F.lit(f"'{f}': "), quoted(badge[f])) for f in ("name", "title", "version")]
        return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))

    text = F.concat(F.lit("["), F.array_join(F.transform("i_badges", one), ", "), F.lit("]"))
    return legacy.withColumn("i_badges", F.coalesce(text, F.lit("None")))


def write_chat(chat: DataFrame, path: str, compression: str = "gzip", edges: list[tuple[str, str]] = EDGE_FILES) -> None:
    """Land messages as chat files: a folder per broadcast, each part file one JSON array.

    REBALANCE brings a broadcast's messages together and splits a hot one over several tasks;
    an array holds the messages of one broadcast in one Arrow batch, so its length is bounded.
    The many partitions it starts from are merged where they are small; few ones would be cut as tables grow,
    and each broadcast in them too.
    """

    # A local function travels to the executors by value; they need not have this package.
    def json_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = pc.run_end_encode(batch["source"])
            at, values, arrays = 0, batch["value"].to_pylist(), []
            for end in ends.run_ends.to_pylist():
                arrays.append("[" + ",\n".join(values[at:end]) + "]")
                at = end
            yield pa.record_batch([ends.values.cast(pa.string()), pa.array(arrays, pa.string())], ["source", "value"])

    number = F.expr(f"cast(vod_id as bigint) div {VOD_STEP}")
    name = F.concat_ws("_", "channel", "year", F.lpad(number.cast("string"), 12, "0"), "vod_id")
    fields = ["author", "emotes", "timestamp", "time_text", "time_in_seconds", "message"]
    rows = chat.select(
        F.concat(name, F.lit(".json")).alias("source"), F.to_json(F.struct(*fields)).alias("value")
    )
    arrays = (
        rows.hint("rebalance", 2000, F.col("source"))
        .sortWithinPartitions("source", "value")
        .mapInArrow(json_arrays, "source string, value string")
    )
    if edges:
        arrays = arrays.unionByName(chat.sparkSession.createDataFrame(edges, "source string, value string"))
    if urlsplit(path).scheme in ("", "file"):
        write_local(arrays, path, compression)
        return
    (
        arrays.write.mode("overwrite")
        .partitionBy("source")
        .option("maxRecordsPerFile", 1)
        .option("compression", compression)
        # Nobody reads before all is written: tasks move their own files, not the driver all of them.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .text(path)
    )


def write_local(arrays: DataFrame, path: str, compression: str) -> None:
    """Store rows (source, value) on a file system that driver and executors share by a mount, a file a row.

    Folders and names are those of Spark's writer, which on local file systems starts a process for each file
    to set its mode. A retried task gives its files the same names again.
    """
    root = "/" + path.removeprefix("file:").lstrip("/")

    # A local function travels to the executors by value; they need not have this package.
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, files = TaskContext.get(), 0
        for batch in batches:
            for source, value in zip(batch["source"].to_pylist(), batch["value"].to_pylist()):
                folder = re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", source)
                folder = f"{root}/source={folder}"
                os.makedirs(folder, exist_ok=True)
                end = ".txt.gz" if compression == "gzip" else ".txt"
                own = f"{folder}/.attempt-{task.taskAttemptId()}{end}"
                data = f"{value}\n".encode()
                with open(own, "wb") as file:
                    file.write(gzip.compress(data, 1) if compression == "gzip" else data)
                os.replace(own, f"{folder}/part-{task.partitionId():05d}-{files:06d}{end}")
                files += 1
        yield pa.record_batch([pa.array([files], pa.int64())], ["files"])

    arrays.mapInArrow(store, "files bigint").agg(F.sum("files")).collect()


def write_first_layouts(panel: DataFrame, path: str) -> None:
    """A silver table part by broadcast, as the first layout had it, and part by year.

    A broadcast's rows meet in one task first; else every task would write a file of every broadcast.
    """
    for left, folders in enumerate((["channel", "year", "vod_id"], ["channel", "year"])):
        rows = panel.filter(F.col("year") % 2 == left).hint("rebalance", 2000, *map(F.col, folders))
        (
            rows.write.mode("append")
            .partitionBy(*folders)
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .parquet(path)
        )


SHARE_MESSAGES = 24_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def landed_shares(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """Paths of the landed chat files of a set of tables, without compression, as only such can be read by ranges.

    Plain text takes some 270 bytes a message, so it is not landed all at once: each share holds whole broadcasts with
    some 24 million messages together. It is deleted when the next one is asked for, and shuffles end with the query
    that made them.
    """
    shares = max(1, math.ceil(table(spark, sf_dir, "lineitem").count() / SHARE_MESSAGES))
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        for number in range(shares):
            path = scratch_dir(spark, "raw")
            write_chat(messages(spark, sf_dir, (number, shares)), path, "none", EDGE_FILES if number == 0 else [])
            yield path
            Storage(spark, path).delete()
    finally:
        spark.conf.set(CLEANUP, before)


_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> str:
    """Path of the landed chat files of a set of tables; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, compression)
    if key not in _landed:
        path = scratch_dir(spark, "raw")
        write_chat(messages(spark, sf_dir), path, compression)
        _landed[key] = path
    return _landed[key]

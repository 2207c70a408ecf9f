"""Incremental ingest of chat files with Structured Streaming."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom.functions.columns import plain_path
from chatloom.operators.audit import file_status
from chatloom.operators.panel import emote_panel
from chatloom.schemas import CHAT, LEDGER, PARTITIONS
from chatloom.session import scratch_dir
from chatloom.sources.chat import broken_files, list_files, literal_path, read_chat, with_file_metadata
from chatloom.sources.panels import read_ledger

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession, in_path: str, out_path: str, checkpoint: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Take up the chat files not seen before, and those that have changed since, then stop.

    Each batch writes its panel rows to ``panel/ingest=<batch>`` and then, to ``ledger/ingest=<batch>``, one entry per
    file: status (``processed``, ``no_emote`` or ``failed``), counts, length and time. Both are replaced when a
    batch runs again, and rows count once the ledger has their batch, so nothing is lost or doubled.
    A file whose length or time differs from its latest entry, such as a repaired one, is offered again before the
    stream starts; its new rows take the place of the old ones. Read with ``read_silver(..., streamed=True)`` and
    ``read_ledger``. Files whose names are not chat files' are passed over.
    """
    take_up_changed(spark, in_path, out_path, files_per_batch)
    files = (
        spark.readStream.schema(FILES)
        .format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(in_path)
        # A batch is handed on as it was scanned: what is not dropped here, the text of every file, would be read.
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )

    def land(listed: DataFrame, batch_id: int) -> None:
        named = with_file_metadata(listed, F.col("path")).filter(F.col("file_name").isNotNull())
        take_up(named, out_path, f"batch-{batch_id:012d}")

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def take_up_changed(spark: SparkSession, in_path: str, out_path: str, files_per_batch: int) -> None:
    """Take up files anew that differ from their latest entry, in batches of about ``files_per_batch``."""
    entries = read_ledger(spark, out_path).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    known = list_files(spark, in_path).join(entries, "path")
    changed = known.filter((F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified")))
    changed = changed.drop("_length", "_modified")
    run, batches = uuid.uuid4().hex[:12], math.ceil(changed.count() / files_per_batch)
    for i in range(batches):
        take_up(changed.filter(F.pmod(F.xxhash64("path"), F.lit(batches)) == i), out_path, f"again-{run}-{i:06d}")


def take_up(files: DataFrame, out_path: str, ingest: str) -> None:
    """Write the panel rows of some files, then their entries in the ledger.

    The driver holds the names of one batch of files; messages are parsed once, into typed Parquet.
    """
    spark, root = files.sparkSession, out_path.rstrip("/")
    listed = files.collect()
    if not listed:
        return
    files = spark.createDataFrame(listed, files.schema)
    chat = read_chat(spark, [literal_path(f.path) for f in listed])
    path = plain_path(F.col("_metadata.file_path"))
    staged = with_file_metadata(chat.select(*CHAT.names, F.col("_metadata.file_path").alias("file_path"), path.alias("path")))
    stored = scratch_dir(spark, "landing")
    staged.write.parquet(stored)
    messages = spark.read.schema(staged.schema).parquet(stored)

    rows = emote_panel(messages, keep=[*PARTITIONS, "path"]).hint("rebalance", *map(F.col, PARTITIONS))
    rows.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{root}/panel/ingest={ingest}")

    broken = broken_files(messages).select(plain_path(F.col("file_path")).alias("path"))
    entries = file_status(files, messages, broken, key="path").withColumn("recorded", F.current_timestamp())
    entries.select(*LEDGER.names).coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/ingest={ingest}")

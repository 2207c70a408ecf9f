"""Writers. Each rerun replaces exactly what it produces again."""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.operators.panel import flatten_badges
from chatloom.schemas import CSV, EXACT_CSV, PARTITIONS, REPORT_LABELS
from chatloom.storage import Storage

# Keeps one output file to a size that readers split well.
ROWS_PER_FILE = 20_000_000


# Readers cannot split a CSV file whose records have line breaks, so it is one task's work.
ROWS_PER_UNSPLIT_FILE = 200_000


def _sized(df: DataFrame, files: int | None, keys: list[str]) -> DataFrame:
    """Even partitions for a write: as many as the data needs, a folder's rows dealt into ``files`` slices if given.

    REBALANCE brings the rows of a key, or a slice of it, together but splits a hot one and merges small ones.
    """
    if not files:
        return df.hint("rebalance", *map(F.col, keys))
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*map(F.col, df.columns)), F.lit(files)))
    return sliced.hint("rebalance", *map(F.col, [*keys, "_slice"])).drop("_slice")


def _partitioned(df: DataFrame, keys: list[str], mode: str = "overwrite"):
    return (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*keys)
    )


BUCKET = re.compile(r"bucket=\d+of(\d+)$")
FOLDERS = "channel=*/year=*/bucket=*"


def write_silver(panel: DataFrame, path: str, buckets: int = 8) -> None:
    """Silver panel; a rerun replaces the broadcasts it has rows for and no others.

    A channel's year is ``buckets`` folders, whatever its number of broadcasts (the first write fixes how
    many). A broadcast's rows lie in the bucket that a hash of its VOD id says, or of its ``file_name`` where there
    is no id; that column, if the panel has it, goes no further. Only touched buckets are read, without the
    broadcasts that come anew, and written again with these.

    Rows are staged inside the table's path, out of readers' sight, and moved into place at the end, so
    a panel may be made from the table itself. A write that was stopped while moving is finished by the next one.
    One writer at a time.
    """
    spark, table = panel.sparkSession, Storage(panel.sparkSession, path)
    finish_writes(table)
    stored = _bucket_folders(table)
    if stored:
        buckets = int(BUCKET.search(stored[0])[1])
    names = ["vod_id", *(["file_name"] if "file_name" in panel.columns else [])]
    rows = panel.withColumn("source", F.coalesce(*names, F.lit("-"))).drop("file_name")
    bucket = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(buckets)).cast("int")
    rows = rows.withColumn("bucket", F.format_string(f"%dof{buckets}", bucket))

    staged = f"_staged/{uuid.uuid4().hex}"
    unit = [*PARTITIONS, "bucket"]

    def stage(part: DataFrame) -> None:
        sized = _sized(part, None, unit).sortWithinPartitions(*unit, "source")
        _partitioned(sized, unit, "append").parquet(f"{table.root}/{staged}")

    stage(rows)
    touched = [name.removeprefix(f"{staged}/") for name in table.matching(f"{staged}/{FOLDERS}")]
    old = [name for name in touched if name in set(stored)]
    if old:
        keys = [*PARTITIONS, "source"]
        fresh = _read_folders(spark, table, [f"{staged}/{name}" for name in touched], staged)
        stage(_read_folders(spark, table, old).join(fresh.select(*keys).distinct(), keys, "left_anti"))
    table.touch(f"{staged}/_READY")
    finish_writes(table)


def finish_writes(table: Storage) -> None:
    """Move what a whole staged write has left to move; what an unfinished one has staged is dropped."""
    for staged in table.matching("_staged/*"):
        if table.exists(f"{staged}/_READY"):
            for folder in table.matching(f"{staged}/{FOLDERS}"):
                table.replace(folder.removeprefix(f"{staged}/"), by=folder)
        table.delete(staged)


def _bucket_folders(table: Storage) -> list[str]:
    """The folders of a table's buckets; tables of earlier layouts have to be migrated first."""
    found = [name for name in table.matching("channel=*/year=*/*") if not name.rpartition("/")[2].startswith(("_", "."))]
    if any(not BUCKET.search(name) for name in found):
        raise ValueError(f"{table.root} has an earlier layout: copy it with chatloom.plans.migrate_silver")
    return found


def _read_folders(spark: SparkSession, table: Storage, folders: list[str], base: str = "") -> DataFrame:
    """Some folders of a table with all their columns; channels and buckets are text whatever they look like."""
    kinds = {"channel": T.StringType(), "year": T.IntegerType(), "bucket": T.StringType()}
    paths = [f"{table.root}/{name}" for name in folders]
    reader = lambda: spark.read.option("basePath", f"{table.root}/{base}")
    found = reader().option("mergeSchema", True).parquet(*paths).schema
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found]
    return reader().schema(T.StructType(fields)).parquet(*paths)


def write_gold_parquet(gold: DataFrame, path: str, files: int | None = None) -> None:
    """Gold panel by channel and year; ``files`` says in how many files each folder is cut, fewer if they are
    small and more if one would be too much for a task."""
    _partitioned(_sized(gold, files, PARTITIONS), PARTITIONS).parquet(path)


def write_gold_csv(gold: DataFrame, path: str, files: int | None = None, exact: bool = False) -> None:
    """Gold panel as CSV with header, badge arrays joined by commas.

    With ``exact`` no record has a line break inside, so that readers may split the files, and
    :func:`chatloom.sources.read_gold_csv` gives back the very rows: NULL is ``\\N``, in a list ``\\0``, an empty list ``\\E``, and a
    backslash stands before ``n`` and ``r`` for line breaks, before commas in list elements, and before itself.
    """
    flat = gold.select(*(escaped_column(f) for f in gold.schema)) if exact else flatten_badges(gold, ",")
    _partitioned(_sized(flat, files, PARTITIONS), PARTITIONS).options(**(EXACT_CSV if exact else CSV)).csv(path)


def escaped_column(field: T.StructField) -> Column:
    """A column as the exact CSV form holds it."""
    column = F.col(field.name)
    if field.name in PARTITIONS:
        return column
    if isinstance(field.dataType, T.ArrayType):
        element = lambda x: F.coalesce(F.replace(_escaped(x), F.lit(","), F.lit("\\,")), F.lit("\\0"))
        joined = F.array_join(F.transform(column, element), ",")
        return F.when(F.size(column) == 0, F.lit("\\E")).otherwise(joined).alias(field.name)
    return _escaped(column).alias(field.name) if isinstance(field.dataType, T.StringType) else column


def _escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def write_report(report: DataFrame, path: str, format: str = "csv", labels: bool = False) -> None:
    """A report table as CSV or Parquet, with the headings readers know if ``labels``."""
    if labels:
        report = report.withColumnsRenamed(REPORT_LABELS)
    report.write.mode("overwrite").format(format).options(**(CSV if format == "csv" else {})).save(path)


def write_legacy_csv(panel: DataFrame, path: str) -> None:
    """A panel as CSV: text arrays joined by ``", "``, struct arrays as JSON. Long files are cut by rows."""
    columns = []
    for field in panel.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            texts = isinstance(field.dataType.elementType, T.StringType)
            column = F.concat_ws(", ", column) if texts else F.to_json(column)
        columns.append(column.alias(field.name))
    writer = panel.select(*columns).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_UNSPLIT_FILE)
    writer.options(**CSV).csv(path)


def register_views(df: DataFrame, name: str) -> DataFrame:
    """Name a result for SQL and hand it back."""
    df.createOrReplaceTempView(name)
    return df


class Inspection(NamedTuple):
    schema: T.StructType
    rows: int
    head: DataFrame


def inspect(df: DataFrame, n: int = 20) -> Inspection:
    """Schema, number of rows and the first ``n`` rows (as a DataFrame) of a table."""
    return Inspection(df.schema, df.count(), df.limit(n))

"""Stored panels: silver and gold Parquet, legacy CSV."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.frames import parse_years
from chatloom.schemas import EXACT_CSV, GOLD, LEDGER, LEGACY, LEGACY_FLAT, PANEL, PARTITIONS, RENAMED, partitioned
from chatloom.storage import Storage


def _old_names(schema: T.StructType) -> T.StructType:
    """The columns of the schema that earlier revisions called otherwise, under their old names."""
    kinds = {field.name: field.dataType for field in schema}
    return T.StructType([T.StructField(old, kinds[new]) for old, new in RENAMED.items() if new in kinds])


def _old_files(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> list[str]:
    """Files with anything in a column of an old name. Other files have nothing to read but their footer."""
    old = _old_names(schema)
    if not old:
        return []
    rows = spark.read.schema(old).option("basePath", root).parquet(*paths)
    filled = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in old.names])
    found = rows.filter(filled).select("_metadata.file_path").distinct().collect()
    return sorted(_path_of(r.file_path) for r in found)


def _path_of(uri: str) -> str:
    """A file's path as a reader takes it; listings and scans spell local ones with one slash or three."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def read_revisions(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files of any revision under the current names.

    Files that hold old names are scanned apart from the others, each group under its own names, so that
    a filter reaches the scan whichever names it meets. Which files these are is found out beforehand;
    a table whose folders are buckets was written by this library, under the current names.
    """

    def scan(files: list[str], asked: T.StructType) -> DataFrame:
        return spark.read.schema(asked).option("basePath", root).parquet(*files)

    current = scan(paths, schema)
    files = current.inputFiles()
    if all("/bucket=" in file for file in files):
        return current
    old = set(_old_files(spark, root, paths, schema))
    if not old:
        return current
    new_of = {old_name: new for old_name, new in RENAMED.items() if new in schema.names}
    both = T.StructType([*schema, *_old_names(schema)])
    renamed = scan(sorted(old), both)
    merged = {new: F.coalesce(new, name).alias(new) for name, new in new_of.items()}
    # A file of the old revision lacks the new name unless it was written with both.
    stored = set(spark.read.option("mergeSchema", True).parquet(*sorted(old)).columns)
    for name, new in new_of.items():
        if new not in stored:
            merged[new] = F.col(name).alias(new)
    renamed = renamed.select(*(merged.get(c, F.col(c)) for c in schema.names))
    rest = sorted(set(map(_path_of, files)) - old)
    return scan(rest, schema).unionByName(renamed) if rest else renamed


def _read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, channel: str | None, years: str | Iterable | None
) -> DataFrame:
    """Only the folders of the wanted channel and years are listed; none there is no error."""
    wanted = None if years is None else parse_years(years)
    glob = f"channel={channel or '*'}/year=" + ("*" if wanted is None else "{%s}" % ",".join(map(str, wanted)))
    root, full = path.rstrip("/"), partitioned(schema)
    if wanted == []:
        return spark.createDataFrame([], full)
    try:
        return read_revisions(spark, root, [f"{root}/{glob}"], full).select(*full.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_silver(
    spark: SparkSession,
    path: str,
    channel: str | None = None,
    years: str | Iterable | None = None,
    streamed: bool = False,
) -> DataFrame:
    """Silver panel of the chosen channel and years.

    ``streamed`` is for a table that :func:`chatloom.streaming.ingest_stream` writes: there the ledger says
    which rows count.
    """
    if streamed:
        return read_streamed(spark, path, channel, years)
    return _read_partitions(spark, path, PANEL, channel, years)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of every file that :func:`chatloom.streaming.ingest_stream` has taken up."""
    entries = _ledger_entries(spark, path)
    latest = entries.groupBy("path").agg(F.max(F.struct("recorded", "ingest")).alias("last"))
    latest = latest.select("path", F.col("last.ingest").alias("ingest"))
    return entries.join(latest, ["path", "ingest"]).select(*LEDGER.names, "ingest")


def _ledger_entries(spark: SparkSession, path: str) -> DataFrame:
    full = T.StructType([*LEDGER, T.StructField("ingest", T.StringType())])
    root = f"{path.rstrip('/')}/ledger"
    whole = _whole_ingests(spark, root)
    if not whole:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).parquet(*(f"{root}/{name}" for name in whole))


def _whole_ingests(spark: SparkSession, root: str) -> list[str]:
    """The ledger's folders whose write has ended."""
    return [name.rpartition("/")[0] for name in Storage(spark, root).matching("ingest=*/_SUCCESS")]


def read_streamed(
    spark: SparkSession, path: str, channel: str | None = None, years: str | Iterable | None = None
) -> DataFrame:
    """The panel rows of each file's latest version, by the ledger.

    A batch counts once its ledger is whole, so what failed attempts left behind is not seen. Rows of a
    file that was taken up again later are left out by a join with the superseded versions alone.
    """
    full, root = partitioned(PANEL), f"{path.rstrip('/')}/panel"
    wanted = None if years is None else parse_years(years)
    # A batch without any panel row has no channel folder.
    storage = Storage(spark, root)
    whole = [n for n in _whole_ingests(spark, f"{path.rstrip('/')}/ledger") if storage.matching(f"{n}/channel=*")]
    if not whole or wanted == []:
        return spark.createDataFrame([], full)
    asked = T.StructType([*full, T.StructField("path", T.StringType()), T.StructField("ingest", T.StringType())])
    rows = spark.read.schema(asked).option("basePath", root).parquet(*(f"{root}/{name}" for name in whole))
    if channel is not None:
        rows = rows.filter(F.col("channel") == channel)
    if wanted is not None:
        rows = rows.filter(F.col("year").isin(wanted))
    entries = _ledger_entries(spark, path).select("path", "ingest")
    superseded = entries.exceptAll(read_ledger(spark, path).select("path", "ingest"))
    return rows.join(superseded, ["path", "ingest"], "left_anti").select(*full.names)


def read_gold(
    spark: SparkSession, path: str, channel: str | None = None, years: str | Iterable | None = None
) -> DataFrame:
    """Gold panel of the chosen channel and years."""
    return _read_partitions(spark, path, GOLD, channel, years)


def read_gold_csv(
    spark: SparkSession, path: str, channel: str | None = None, years: str | Iterable | None = None
) -> DataFrame:
    """Gold panel that ``write_gold_csv(..., exact=True)`` has written, with the very values of its rows."""
    full = partitioned(GOLD)
    lists = {f.name for f in full if isinstance(f.dataType, T.ArrayType)}
    flat = T.StructType([T.StructField(f.name, T.StringType() if f.name in lists else f.dataType) for f in full])
    rows = spark.read.schema(flat).options(**EXACT_CSV).csv(path)
    if channel is not None:
        rows = rows.filter(F.col("channel") == channel)
    if years is not None:
        rows = rows.filter(F.col("year").isin(parse_years(years)))

    def restored(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.name in lists:
            # A comma before the first element too: then each element follows one.
            parts = F.regexp_extract_all(F.concat(F.lit(","), column), F.lit(r",((?:[^,\\]|\\.)*)"), F.lit(1))
            element = lambda x: F.when(x != "\\0", _unescaped(x))
            column = F.when(column == "\\E", F.array().cast(field.dataType)).otherwise(F.transform(parts, element))
        elif isinstance(field.dataType, T.StringType) and field.name not in PARTITIONS:
            column = _unescaped(column)
        return column.alias(field.name)

    return rows.select(*map(restored, full))


def _unescaped(text: Column) -> Column:
    """What an escaped text stands for; between doubled backslashes a single one starts an escape."""

    def part(p: Column) -> Column:
        for written, plain in (("\\n", "\n"), ("\\r", "\r"), ("\\,", ",")):
            p = F.replace(p, F.lit(written), F.lit(plain))
        return p

    parts = F.transform(F.split(text, r"\\\\"), part)
    return F.when(text.contains("\\"), F.array_join(parts, "\\")).otherwise(text)


def read_legacy_panel(spark: SparkSession, paths: str | list[str], flat_badges: bool = False) -> DataFrame:
    """Old panel CSV files as one table; ``flat_badges`` for the form with joined badge text."""
    return (
        spark.read.schema(LEGACY_FLAT if flat_badges else LEGACY)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(paths)
    )

"""Silver panel to gold table, with its report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from chatloom.functions.frames import parse_years, year_frame
from chatloom.operators.gold import attach_titles, gold_report
from chatloom.operators.panel import normalize_panel
from chatloom.sinks.tables import write_gold_csv, write_gold_parquet
from chatloom.sources.panels import read_gold, read_silver
from chatloom.storage import Storage


def build_gold(
    spark: SparkSession,
    silver_path: str,
    vods: DataFrame,
    gold_path: str,
    channel: str,
    years: str | Iterable,
    csv_path: str | None = None,
    files: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """Write one channel's gold table, as CSV too if asked for; give back the report.

    The join runs once: CSV and report are made from the Parquet table just written. Of an asked year without
    silver rows, what an older run has left is taken out of both.
    """
    silver = normalize_panel(read_silver(spark, silver_path, channel, years))
    write_gold_parquet(attach_titles(silver, vods), gold_path, files)
    present = {row.year for row in silver.select("year").distinct().collect()}
    absent = [f"channel={channel}/year={year}" for year in parse_years(years) if year not in present]
    _clear(spark, gold_path, absent)
    gold = read_gold(spark, gold_path, channel, years)
    if csv_path is not None:
        write_gold_csv(gold, csv_path, files, exact)
        _clear(spark, csv_path, absent)
    return gold_report(gold, year_frame(spark, years))


def _clear(spark: SparkSession, path: str, folders: list[str]) -> None:
    table = Storage(spark, path)
    for folder in folders:
        table.delete(folder)

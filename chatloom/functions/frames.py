"""Helpers on whole DataFrames: numbering without one big window, years."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def parse_years(years: str | int | Iterable[str | int]) -> list[int]:
    """Four-digit years from text such as ``"2020, 2021"`` or a list; anything else is ignored."""
    items = years.split(",") if isinstance(years, str) else [years] if isinstance(years, int) else years
    texts = [str(item).strip() for item in items]
    return [int(text) for text in texts if len(text) == 4 and text.isdecimal()]


def year_frame(spark: SparkSession, years: str | Iterable[str | int]) -> DataFrame:
    """The requested years as a table, so that reports keep a row for empty years."""
    rows = [(year,) for year in dict.fromkeys(parse_years(years))]
    return spark.createDataFrame(rows, "year int")


def numbered(
    df: DataFrame,
    name: str,
    group: Sequence[str],
    buckets: Sequence[Column],
    order: Sequence[str],
    start: int = 1,
) -> DataFrame:
    """Number the rows of each group in ``order``, without sorting a whole group in one task.

    ``buckets`` divide a group, each one the pieces of the one before, and must not decrease
    along ``order``. Rows are numbered inside the smallest piece; how many rows lie before a
    piece comes from running totals over piece counts, one level after the other.
    """
    columns = [f"_bucket{i}" for i in range(len(buckets))]
    rows = df.withColumns(dict(zip(columns, buckets)))
    keys = [*group, *columns]
    pieces = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offset = F.lit(start - 1)
    for i in reversed(range(len(buckets))):
        # Pieces of this level, with how many rows lie before each inside the piece that holds it.
        outer, inner = keys[: len(group) + i], keys[: len(group) + i + 1]
        earlier = Window.partitionBy(*outer).orderBy(columns[i]).rowsBetween(Window.unboundedPreceding, -1)
        level = pieces.select(*keys, "_rows") if i == len(buckets) - 1 else pieces.groupBy(*inner).agg(F.sum("_rows").alias("_rows"))
        before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(f"_before{i}")
        level = level.select(*inner, before)
        offsets = level if i == len(buckets) - 1 else offsets.join(level.hint("merge"), inner)
        offset = offset + F.col(f"_before{i}")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) + offset
    # There may be about as many pieces as rows: no table for the driver to hand out. Window and join share a shuffle.
    return rows.join(offsets.hint("merge"), keys).withColumn(name, number).select(*df.columns, name)

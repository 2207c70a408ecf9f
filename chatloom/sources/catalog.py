"""The catalogue of recorded broadcasts (VODs)."""

from pyspark.sql import DataFrame, SparkSession

from chatloom.schemas import VOD


def read_catalog(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Catalogue CSV with header. Quotes inside titles are doubled, as CSV writers do."""
    return spark.read.schema(VOD).option("header", True).option("escape", '"').csv(path)

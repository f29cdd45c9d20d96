"""Results as JSON text."""

from pyspark.sql import DataFrame, functions as F


def to_json_rows(df: DataFrame) -> DataFrame:
    """One `json` column; null fields are written as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))

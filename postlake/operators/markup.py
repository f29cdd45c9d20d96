"""Markup clean-up as a table job."""

from pyspark.sql import DataFrame, functions as F

from postlake.functions.text import clean_markup


def strip_markup(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, clean_markup(F.col(column)))

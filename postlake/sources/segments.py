"""Tables that grow by segments: every update adds one and writes nothing else.

A table `name` below a path has a folder per segment. A segment counts once its marker below
`published` is there, which is written last and names the update; `replaced` holds the ids
whose rows in earlier segments no longer count.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

REPLACED = "post_id string, segment int"


def folder(path: str, table: str, segment: int) -> str:
    return f"{path.rstrip('/')}/{table}/segment={segment}"


def read_segments(spark: SparkSession, path: str, table: str, schema, segments: list) -> DataFrame:
    top = f"{path.rstrip('/')}/{table}"
    return spark.read.schema(schema).option("basePath", top).parquet(*[folder(path, table, n) for n in segments])


def markers(spark: SparkSession, path: str, schema) -> list:
    """All published segments in order, as rows with `segment`."""
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/published").collect()
    return sorted(rows, key=lambda row: row.segment)


def publish(marker: DataFrame, path: str, segment: int) -> None:
    """Of two writers of one segment the second fails."""
    marker.coalesce(1).write.mode("error").parquet(folder(path, "published", segment))


def replaced_since(spark: SparkSession, path: str, segments: list) -> DataFrame | None:
    """(post_id, since): the last segment that replaced an id, None if there is but one segment."""
    if len(segments) < 2:
        return None
    rows = read_segments(spark, path, "replaced", REPLACED, segments[1:])
    return rows.groupBy("post_id").agg(F.max("segment").alias("since"))


def only_live(rows: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """Rows (post_id, segment, ...) without those that a later segment replaced."""
    if replaced is None:
        return rows
    joined = rows.join(replaced, "post_id", "left")
    return joined.where(F.col("since").isNull() | (F.col("segment") >= F.col("since"))).drop("since")

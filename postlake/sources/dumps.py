"""Raw result dumps: text files with one JSON envelope (one page of items) per line."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: shape of the envelope. Items stay JSON text, decoded later.
ENVELOPE = (
    "ok boolean, data struct<result: struct<chunks: array<struct<"
    "sequence: bigint, items: array<string>>>>>"
)


# Where a file's name or folder tells its day: the last date in it.
DAY_PATTERN = r".*([0-9]{4}-[0-9]{2}-[0-9]{2})"
# A file that one write of Spark made beside others: they are of one job, however they end.
PART_PATTERN = r"^(.*)/part-[0-9]+-[^/]*$"


def file_job(pattern: str = DAY_PATTERN) -> Column:
    """The job a dump file belongs to, which sorts by age. Its day is the first group of the
    pattern in the file's path, else that on which the file was last written. Files of one day
    follow each other by the time of writing and then by name, whatever their sequences. The
    part files of one folder are one job, and such jobs of a day go by the folder's name."""
    path, written = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    named, parts = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, PART_PATTERN, 1)
    day = F.when(named != "", named).otherwise(F.date_format(written, "yyyy-MM-dd"))
    moment = F.date_format(written, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat_ws(" ", day, F.when(parts != "", F.lit("")).otherwise(moment), F.when(parts != "", parts).otherwise(path))


def read_raw_items(spark: SparkSession, path: str, job: Column | None = None) -> DataFrame:
    """(job, sequence, chunk, pos, item_json); the first four give the arrival order.

    Sequences count inside one job only, so the job comes first: file_job unless another
    column over the file's `_metadata` is given. One page per line keeps a dump splittable:
    its lines spread over tasks whatever the size of the file.
    """
    return flatten_envelopes(spark.read.text(path), F.col("value"), file_job() if job is None else job)


def stream_raw_items(spark: SparkSession, path: str, job: Column | None = None) -> DataFrame:
    return flatten_envelopes(spark.readStream.text(path), F.col("value"), file_job() if job is None else job)


def flatten_envelopes(lines: DataFrame, line: Column, job: Column | None = None) -> DataFrame:
    """Explode envelopes into items. Lines that are no JSON object are log noise; an
    envelope that does not say ok fails the job, since its page would be missing."""
    job = F.lit("") if job is None else job
    envelope = F.from_json(line, ENVELOPE)
    chunks = F.when(F.col("envelope.ok"), F.col("envelope.data.result.chunks")).otherwise(
        F.raise_error(F.lit("dump holds an envelope that is not ok"))
    )
    return (
        lines.where(F.ltrim(line).startswith("{"))
        .select(job.alias("job"), envelope.alias("envelope"))
        .select("job", F.posexplode(chunks).alias("chunk", "c"))
        .select(
            "job",
            F.coalesce("c.sequence", F.lit(0)).alias("sequence"),
            "chunk",
            F.posexplode("c.items").alias("pos", "item_json"),
        )
    )

"""The rendered corpus: one small text document per post that is no repost.

Stored documents are a row of segments: the first has the documents of all posts, and every
update adds those it wrote and the ids whose documents are replaced or gone.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.operators.corpus import render_body
from postlake.schemas import CORPUS
from postlake.session import save
from postlake.sources.segments import folder, markers, only_live, publish, read_segments, replaced_since

# Fixed value: header line, blank line, content, final newline.
DOCUMENT_FORM = r"(?s)\A([0-9-]*) \| (-?\d+) likes\n\n(.*)\n\z"
STORED = "post_id string, file_name string, body string, segment int"
MARKERS = "name string, segment int"


def _store(rendered: DataFrame, path: str, number: int) -> None:
    """Oldest first within each file. One file per post would be millions of tiny files; the
    file name is a column."""
    age = [F.col("created_at").asc_nulls_first(), F.col("post_id")]
    laid_out = rendered.repartitionByRange(*age).sortWithinPartitions(*age).select(*CORPUS.fieldNames())
    save(laid_out, folder(path, "documents", number), "overwrite")


def write_corpus(posts: DataFrame, path: str) -> None:
    """The documents of all posts, as the first segment of a new corpus."""
    _store(render_body(posts), path, 1)
    publish(posts.sparkSession.createDataFrame([(None,)], "name string"), path, 1)


def write_corpus_changes(spark: SparkSession, path: str, written: DataFrame, removed: DataFrame, name: str) -> None:
    """Add an update to a stored corpus: posts whose document is new or differs, and ids whose
    document goes. An update that was added already is not added again."""
    segments = markers(spark, path, MARKERS)
    if any(row.name == name for row in segments):
        return
    number = segments[-1].segment + 1
    _store(render_body(written), path, number)
    ids = written.select("post_id").union(removed.select("post_id")).distinct()
    save(ids, folder(path, "replaced", number), "overwrite")
    publish(spark.createDataFrame([(name,)], "name string"), path, number)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, post_date, like_count, content) from a folder of <id>.txt files."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return parse_documents(
        files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("body"))
    )


def read_rendered(spark: SparkSession, path: str, *columns: Column) -> DataFrame:
    """(post_id, file_name, body) of a stored corpus as its segments stand now; or the columns
    given, which are made of a document before those that do not count are left out, so that no
    more than them is shuffled."""
    numbers = [row.segment for row in markers(spark, path, MARKERS)]
    rows = read_segments(spark, path, "documents", STORED, numbers)
    wanted = [F.col(c) for c in CORPUS.fieldNames()] if not columns else list(columns)
    found = rows.select(F.struct("post_id", "segment").alias("key"), F.struct(*wanted).alias("row"))
    return only_live(found.select("key.*", "row"), replaced_since(spark, path, numbers)).select("row.*")


def parse_documents(documents: DataFrame) -> DataFrame:
    """Inverse of the renderer, for any frame with file_name and body."""
    return documents.select(
        F.regexp_replace("file_name", r"\.[^.]*$", "").alias("post_id"),
        F.regexp_extract("body", DOCUMENT_FORM, 1).try_cast("date").alias("post_date"),
        F.regexp_extract("body", DOCUMENT_FORM, 2).try_cast("bigint").alias("like_count"),
        F.regexp_extract("body", DOCUMENT_FORM, 3).alias("content"),
    )

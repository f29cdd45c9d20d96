"""Ingest of raw dumps, as one batch or as a stream of arriving files."""

import uuid
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.operators.decode import decode_rows, split_rows
from postlake.operators.dedupe import dedupe_last
from postlake.operators.incremental import NO_BOUND, judge_batch, judged_report
from postlake.operators.joins import lookup_ids
from postlake.operators.textindex import published_segments, write_segment
from postlake.schemas import POST_COLUMNS
from postlake.session import drop_stage, drop_stage_part, save, stage
from postlake.sources.archive import (
    Update,
    archive_newest,
    archive_slices,
    current_version,
    published_exists,
    read_posts_near,
    read_posts_or_empty,
    slice_of,
    was_published,
)
from postlake.sources.corpus import write_corpus_changes
from postlake.sources.dumps import read_raw_items, stream_raw_items

BOUND = "late_bound"


class GapError(RuntimeError):
    """A catch-up batch leaves a gap to what is archived."""


class EmptyBatchError(RuntimeError):
    """A batch without a single readable post."""


def rejects_dir(archive_dir: str, version: str) -> str:
    """Where the unreadable items of the batch behind a version are kept."""
    return f"{archive_dir.rstrip('/')}/rejects/version={version}"


class _Batch:
    """One batch on its way into the archive: decoded once, then judged and written slice by slice
    of ids, so that no more than a slice is shuffled or staged beside its old posts at a time. The
    archive is only read in the ranges of ids that the batch falls into."""

    def __init__(self, spark, raw: DataFrame, archive_dir: str, bound=None):
        self.spark, self.archive_dir = spark, archive_dir
        self.slices = archive_slices(spark, archive_dir)
        self.base = current_version(spark, archive_dir)
        self.newest_before = archive_newest(spark, archive_dir)
        # The items are kept of unreadable rows only.
        rows = decode_rows(raw).withColumn("item_json", F.when(F.col("problem").isNotNull(), F.col("item_json")))
        self.decoded = stage(rows.withColumn("slice", slice_of(self.slices)), "decoded", lean=True, by=["slice"])
        self.posts, self.rejects = split_rows(self.decoded, "slice")
        self.bound = self.newest_before if bound is None else None if bound == NO_BOUND else bound

    def refuse_empty(self, version: str) -> None:
        if self.posts.isEmpty():
            raise EmptyBatchError(f"no readable post for version {version}")

    def refuse_gap(self) -> None:
        ids = self.posts.select("post_id")
        if self.newest_before is not None and lookup_ids(read_posts_near(self.spark, self.archive_dir, ids).select("post_id"), ids).isEmpty():
            raise GapError("none of the posts sent is archived yet, so posts between may be missing")

    def keep_rejects(self, version: str) -> DataFrame:
        """Write the unreadable items, and read them from where they are kept."""
        path = rejects_dir(self.archive_dir, version)
        if self.rejects.isEmpty():
            return self.spark.createDataFrame([], self.rejects.schema)
        save(self.rejects, path, "overwrite")
        return self.spark.read.schema(self.rejects.schema).parquet(path)

    def judged(self):
        """(slice, its posts judged) one after the other; a slice is dropped once it was used."""
        # As text, so that no time zone of the driver or the session comes in.
        time = F.lit(None if self.bound is None else str(self.bound)).cast("timestamp_ntz")
        for number, part in enumerate(self.slices):
            posts = stage(dedupe_last(self.posts.where(F.col("slice") == number)), "batch", lean=True)
            old = part.holds(read_posts_near(self.spark, self.archive_dir, posts))
            judged = stage(judge_batch(posts, old, time), "judged", lean=True)
            drop_stage(posts)
            drop_stage_part(self.decoded, "slice", number)
            yield part, judged
            drop_stage(judged)

    def drop(self) -> None:
        drop_stage(self.decoded)


def _changes(judged: DataFrame) -> DataFrame:
    return judged.where("not late and change <> 'unchanged'")


def _write_index(spark: SparkSession, index_dir: str, changes: DataFrame, version: str) -> None:
    outdated = changes.where("other_text and old is not null").select("old.*")
    write_segment(spark, index_dir, changes.where("other_text").select(*POST_COLUMNS), outdated, version)


def _write_corpus(spark: SparkSession, corpus_dir: str, changes: DataFrame, version: str) -> None:
    written, removed = (changes.where(f"document = '{d}'").select(*POST_COLUMNS) for d in ("written", "removed"))
    write_corpus_changes(spark, corpus_dir, written, removed, version)


def apply_items(
    spark: SparkSession,
    raw: DataFrame,
    archive_dir: str,
    version: str,
    bound: datetime | str | None = None,
    catch_up: bool = False,
) -> DataFrame:
    """Decode, deduplicate, filter and upsert one batch of raw items, and publish it.

    Returns the rejected items, which are also kept at rejects_dir. A version that was
    published already is left as it is, so a repeated micro-batch does nothing. A batch
    without a readable post raises EmptyBatchError and publishes nothing.
    """
    if was_published(spark, archive_dir, version):
        return split_rows(decode_rows(raw))[1]
    batch = _Batch(spark, raw, archive_dir, bound)
    rejects = batch.keep_rejects(version)
    batch.refuse_empty(version)
    if catch_up:
        batch.refuse_gap()
    update = Update(spark, archive_dir, version, batch.base)
    for part, judged in batch.judged():
        update.put(_changes(judged).select(*POST_COLUMNS), part)
    update.publish()
    batch.drop()
    return rejects


def batch_ingest(
    spark: SparkSession, in_dir: str, archive_dir: str, version: str, catch_up: bool = False
) -> DataFrame:
    """Ingest all dumps of a folder as one batch. Returns the rejected items."""
    return apply_items(spark, read_raw_items(spark, in_dir), archive_dir, version, catch_up=catch_up)


def daily_update(
    spark: SparkSession,
    in_dir: str,
    archive_dir: str,
    version: str,
    catch_up: bool = True,
    dry_run: bool = False,
    index_dir: str | None = None,
    corpus_dir: str | None = None,
) -> DataFrame:
    """Ingest a folder of dumps into the archive, its stored index and its stored corpus, as far
    as they are given, and report on it: one row, see update_report, with `n_rejected`, the
    number of unreadable items, which are kept at rejects_dir.

    The batch is joined with its posts in the archive once, slice by slice. Each of the three is
    written by what changes in it only. Index and corpus take the update under the version's name and once,
    so an update that failed before the archive was published can be run again. A dry run
    writes nothing and returns the figures of plan_update, after the same checks.
    """
    batch = _Batch(spark, read_raw_items(spark, in_dir), archive_dir)
    batch.refuse_empty(version)
    if catch_up:
        batch.refuse_gap()
    n_rejected = F.lit(batch.rejects.count()).cast("bigint").alias("n_rejected")
    newest_before = F.lit(None if batch.newest_before is None else str(batch.newest_before)).cast("timestamp_ntz")
    if not dry_run:
        batch.keep_rejects(version)
        update = Update(spark, archive_dir, version, batch.base)
    texts = published_segments(spark, index_dir)[-1].fields if index_dir is not None else []
    same_text = reduce(and_, [F.col(c).eqNullSafe(F.col(f"old.{c}")) for c in texts], F.lit(True))
    verdicts, changes = [], []
    for part, judged in batch.judged():
        known = F.when(F.col("old").isNotNull(), True).alias("old")
        verdicts.append(stage(judged.select("created_at", known, "late", "change", "document"), "verdicts"))
        if not dry_run:
            # Old texts are kept where the index needs them.
            other = _changes(judged).withColumn("other_text", F.col("old").isNull() | ~same_text)
            slim = other.withColumn("old", F.when(F.col("other_text"), F.col("old"))).where("other_text or document <> 'unchanged'")
            changes.append(stage(slim, "changes", lean=True))
            update.put(_changes(judged).select(*POST_COLUMNS), part)
    batch.drop()
    if not dry_run:
        changed = reduce(DataFrame.unionByName, changes)
        if index_dir is not None:
            _write_index(spark, index_dir, changed, version)
        if corpus_dir is not None:
            _write_corpus(spark, corpus_dir, changed, version)
        update.publish()
        drop_stage(*changes)
    every = reduce(DataFrame.unionByName, verdicts)
    report = judged_report(every, newest_before, read_posts_or_empty(spark, archive_dir)).select("*", n_rejected)
    if dry_run:
        report = report.select(
            "n_posts", F.col("applied").alias("n_kept"), "n_late", "newest", "oldest",
            F.col("newest_before").alias("archive_newest"), "overlaps", "n_rejected",
        )
    row = stage(report, "report")
    drop_stage(*verdicts)
    return row


def _run_state(spark: SparkSession, archive_dir: str, checkpoint: str) -> tuple[str, datetime | None]:
    """(id of the run, the archive's newest time when it began). Both are kept beside the
    checkpoint, so a restarted run goes on with them, and another checkpoint is another run."""
    path = f"{checkpoint.rstrip('/')}-{BOUND}"
    if not published_exists(spark, path):
        newest = archive_newest(spark, archive_dir)
        spark.createDataFrame([(newest, uuid.uuid4().hex)], "latest timestamp_ntz, run_id string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)
    row = spark.read.schema("latest timestamp_ntz, run_id string").parquet(path).head()
    return row.run_id or "run", row.latest


def stream_ingest(
    spark: SparkSession, in_dir: str, archive_dir: str, checkpoint: str, run: str = "run"
) -> StreamingQuery:
    """Ingest the dump files that have arrived and stop; run again for later ones.

    Start a new checkpoint for each run that should take a new late bound. The versions
    written are named by `run`, an id of the checkpoint and the micro-batch, so no two runs
    share one. Unreadable items are kept at rejects_dir; a micro-batch without a readable
    post publishes nothing.
    """
    run_id, bound = _run_state(spark, archive_dir, checkpoint)

    def apply(items: DataFrame, batch_id: int) -> None:
        version = f"{run}-{run_id}-{batch_id}"
        try:
            apply_items(items.sparkSession, items, archive_dir, version, bound or NO_BOUND)
        except EmptyBatchError:
            pass  # its unreadable items are kept, and there is nothing to publish

    return (
        stream_raw_items(spark, in_dir)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Applying a batch to the archive: guard, late rule, classification and upsert.

Batches are one row per post_id (see dedupe_last). The archive is never shuffled while
the batch is small enough for Spark to broadcast; otherwise both sides are partitioned by
post_id once.
"""

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from postlake.functions.times import day_text
from postlake.operators.joins import boundary_seen, lookup_ids
from postlake.operators.stats import archive_latest, archive_summary, batch_summary
from postlake.schemas import POST_COLUMNS, VALUE_COLUMNS

# A bound for late_filter that lets everything pass, as an archive without times does.
NO_BOUND = "no bound"


def classify_changes(batch: DataFrame, archive: DataFrame) -> DataFrame:
    """The batch with `change`: inserted, updated or unchanged, nulls comparing equal."""
    old = lookup_ids(archive, batch).select(
        "post_id", F.struct(*VALUE_COLUMNS).alias("old")
    )
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"old.{c}")) for c in VALUE_COLUMNS])
    change = (
        F.when(F.col("old").isNull(), "inserted").when(differs, "updated").otherwise("unchanged")
    )
    return batch.join(old, "post_id", "left").withColumn("change", change).select(*POST_COLUMNS, "change")


def _late_flags(batch: DataFrame, archive: DataFrame, bound: Column) -> DataFrame:
    known = lookup_ids(archive.select("post_id"), batch).withColumn("known", F.lit(True))
    # No bound: the archive is empty or has no times at all, so nothing can be late.
    on_time = bound.isNull() | F.coalesce(F.col("created_at") >= bound, F.lit(False))
    return batch.join(known, "post_id", "left").withColumn(
        "late", F.col("known").isNull() & ~on_time
    )


def late_filter(
    batch: DataFrame, archive: DataFrame, bound: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept, late). A row is late if its post is unknown and older than the bound.

    The bound is the archive's newest time, unless one fixed earlier is given.
    """
    if bound is None:
        limit = archive_latest(archive).scalar()
    else:
        # As text, so that no time zone of the driver or the session comes in.
        limit = F.lit(None if bound == NO_BOUND else str(bound)).cast("timestamp_ntz")
    flagged = _late_flags(batch, archive, limit)
    kept = flagged.where(~F.col("late")).select(*POST_COLUMNS)
    late = flagged.where("late").select(*POST_COLUMNS)
    return kept, late


def upsert(archive: DataFrame, batch: DataFrame) -> DataFrame:
    """Known ids take all columns of the batch, nulls included; new ids are added."""
    untouched = archive.join(batch.select("post_id"), "post_id", "left_anti")
    return untouched.select(*POST_COLUMNS).unionByName(batch.select(*POST_COLUMNS))


def judge_batch(batch: DataFrame, archive: DataFrame, bound: Column) -> DataFrame:
    """The batch with `old` (its post in the archive as a struct, else null), `late`, `change`
    and `document` (what becomes of its rendered document: written, removed or unchanged; null
    without one): everything an update needs to know, from one left join. The archive need hold
    no other posts than those that the batch may meet."""
    old = lookup_ids(archive, batch).select("post_id", F.struct(*POST_COLUMNS).alias("old"))
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"old.{c}")) for c in VALUE_COLUMNS])
    change = F.when(F.col("old").isNull(), "inserted").when(differs, "updated").otherwise("unchanged")
    on_time = bound.isNull() | F.coalesce(F.col("created_at") >= bound, F.lit(False))
    shown, was_shown = F.col("is_repost") == 0, F.coalesce(F.col("old.is_repost") == 0, F.lit(False))
    # The document shows the day, the likes and the text.
    same = (
        day_text(F.col("created_at")).eqNullSafe(day_text(F.col("old.created_at")))
        & F.coalesce("like_count", F.lit(0)).eqNullSafe(F.coalesce("old.like_count", F.lit(0)))
        & F.coalesce("content", F.lit("")).eqNullSafe(F.coalesce("old.content", F.lit("")))
    )
    document = (
        F.when(shown & was_shown & same, "unchanged").when(shown, "written").when(was_shown, "removed")
    )
    return batch.join(old, "post_id", "left").select(
        *POST_COLUMNS, "old", (F.col("old").isNull() & ~on_time).alias("late"), change.alias("change"), document.alias("document")
    )


def judged_report(judged: DataFrame, newest_before: Column, after: DataFrame) -> DataFrame:
    """update_report from a judged batch and one scan of the archive after the update."""
    kept = ~F.col("late")
    counted = lambda column, value: F.count_if(kept & (F.col(column) == value)).alias(value)
    figures = judged.agg(
        F.count("*").alias("n_posts"), F.count_if(kept).alias("applied"), F.count_if("late").alias("n_late"),
        F.max("created_at").alias("newest"), F.min("created_at").alias("oldest"),
        F.coalesce(F.bool_or(F.col("old").isNotNull()), F.lit(False)).alias("overlaps"),
        *[counted("change", c) for c in ("inserted", "updated")], F.count_if(kept & (F.col("change") == "unchanged")).alias("same"),
        *[counted("document", d) for d in ("written", "removed")],
    )
    archive = archive_summary(after, F.count_if(F.col("is_repost") == 0).alias("files")).select(F.struct("*").alias("row")).scalar()
    return figures.withColumn("a", archive).select(
        "n_posts", "applied", "n_late", "newest", "oldest", newest_before.alias("newest_before"), "overlaps",
        F.struct("inserted", "updated", F.col("same").alias("unchanged")).alias("db"),
        F.struct(F.col("a.files").alias("files"), "written", "removed").alias("corpus"),
        F.struct(*[F.col(f"a.{c}") for c in ("total", "original", "earliest", "latest", "avg_likes", "avg_views")]).alias("archive"),
    )


def gap_check(batch: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(status row, rows allowed through).

    A catch-up batch must share a post with a non-empty archive; otherwise there may be a
    gap, and nothing passes.
    """
    required = archive.agg(F.count("created_at").alias("timed"))
    status = (
        batch_summary(batch, archive)
        .withColumn("overlap_required", (required.scalar() > 0))
        .withColumn(
            "status",
            F.when(F.col("overlap_required") & ~F.col("overlaps"), "gap").otherwise("ok"),
        )
    )
    passes = status.select(F.col("status") == "ok").scalar()
    return status, batch.where(passes)


def plan_update(batch: DataFrame, archive: DataFrame) -> DataFrame:
    """Dry run as one row: what a batch would do, without writing."""
    flagged = _late_flags(batch, archive, archive_latest(archive).scalar())
    return (
        flagged.agg(
            F.count("*").alias("n_posts"),
            F.count_if(~F.col("late")).alias("n_kept"),
            F.count_if("late").alias("n_late"),
            F.max("created_at").alias("newest"),
            F.min("created_at").alias("oldest"),
        )
        .withColumn("archive_newest", archive_latest(archive).scalar())
        .withColumn("overlaps", boundary_seen(batch, archive).scalar())
    )


def change_totals(batch: DataFrame, archive: DataFrame) -> DataFrame:
    """One row: inserted, updated and unchanged among the rows applied, and late ones."""
    kept, late = late_filter(batch, archive)
    return (
        classify_changes(kept, archive)
        .agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "updated", "unchanged")])
        .withColumn("late", late.agg(F.count("*").alias("n")).scalar())
    )


def update_report(before: DataFrame, batch: DataFrame, after: DataFrame, corpus: DataFrame) -> DataFrame:
    """One row with nested figures.

    `before` and `after` are the archive around the update, `corpus` the one-row figures
    of corpus_diff_counts. State before and after is read from the frames given, so the
    report can be made once the update is written.
    """

    def nested(one_row: DataFrame) -> Column:
        return one_row.select(F.struct("*").alias("row")).scalar()

    return (
        plan_update(batch, before)
        .withColumnsRenamed({"n_kept": "applied", "archive_newest": "newest_before"})
        .withColumn("db", nested(change_totals(batch, before).drop("late")))
        .withColumn("corpus", nested(corpus))
        .withColumn("archive", nested(archive_summary(after)))
    )

"""The archive table: folders of posts by ranges of their ids, and a pointer to the current ones.

A version is a list of folders, each with the posts of one range of ids. A job cannot overwrite
the files it reads, so an update writes new folders for the ranges that its posts fall into,
keeps the others, and moves the pointer only after all is written. A reader sees the old
version or the new one, never half of either.
"""

import json
import re
from datetime import datetime
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.operators.incremental import upsert
from postlake.schemas import POST_COLUMNS, POSTS
from postlake.session import drop_stage, save, stage

POINTER = "_current"

#: Posts of a range, about; a range that an update makes larger is split.
RANGE_ROWS = 1_000_000
#: Bytes of text of a range, about, as one task sorts what a range is written from.
RANGE_BYTES = 64_000_000
#: Slices of ids that an update goes through one after the other, at most, so that what it
#: shuffles and stages at a time is a part of the archive.
SLICES = 8


def _pointer_dir(path):
    return f"{path.rstrip('/')}/{POINTER}"


def _version_dir(path, version):
    return f"{path.rstrip('/')}/version={version}"


def published_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the published version, or None for an archive that does not exist yet."""
    return _current(spark, path)[0]


class Range(NamedTuple):
    """Posts from an id on, up to the next range; the first begins at the empty text. `latest`
    is their newest time as text, `size` the bytes of their texts, None if it was not kept."""

    low: str
    folder: str | None
    rows: int
    latest: str | None
    size: int | None = None


def _current(spark: SparkSession, path: str) -> tuple[str | None, list]:
    """(name, ranges) of the published version.

    Pointers are numbered and only ever added, so a failed write leaves the former
    pointer in force. A pointer counts once its job has committed.
    """
    steps = _pointer_steps(spark, path)
    if not steps:
        return None, []
    lines = [json.loads(row.value) for row in spark.read.text(f"{_pointer_dir(path)}/{max(steps):010d}").collect()]
    ranges = [Range(**{key: line[key] for key in Range._fields if key in line}) for line in lines if "folder" in line]
    return lines[0]["version"], sorted(ranges, key=lambda r: r.low)


def archive_newest(spark: SparkSession, path: str) -> datetime | None:
    """The newest time of the published posts, from the pointer alone."""
    times = [r.latest for r in _current(spark, path)[1] if r.latest]
    return max(map(datetime.fromisoformat, times), default=None)


def was_published(spark: SparkSession, path: str, version: str) -> bool:
    """Whether a version is or ever was the current one."""
    steps = _pointer_steps(spark, path)
    pointers = [f"{_pointer_dir(path)}/{step:010d}" for step in steps]
    return bool(steps) and not spark.read.text(pointers).where(F.get_json_object("value", "$.version") == version).isEmpty()


def _pointer_steps(spark, path, complete=True) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(_pointer_dir(path))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [
        int(name) for name in names
        if re.fullmatch(r"\d{10}", name)
        and (not complete or published_exists(spark, f"{_pointer_dir(path)}/{name}"))
    ]


def _read_folders(spark: SparkSession, path: str, folders: list) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], POSTS)
    return spark.read.schema(POSTS).parquet(*[f"{path.rstrip('/')}/{folder}" for folder in folders])


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of the published version, or of a plain parquet folder without a pointer."""
    version, ranges = _current(spark, path)
    return spark.read.schema(POSTS).parquet(path) if version is None else _read_folders(spark, path, [r.folder for r in ranges])


def read_posts_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """Like read_posts, but an archive nothing was published to yet is empty."""
    version, ranges = _current(spark, path)
    return _read_folders(spark, path, [r.folder for r in ranges])


def _range_of(lows: list) -> Column:
    """The number of the range an id falls into. Least ids travel as one sorted array."""
    bounds = np.array([low.encode() for low in lows], object)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        places = np.searchsorted(bounds, np.array([(i or "").encode() for i in ids], object), "right") - 1
        return pd.Series(places.astype(np.int32))

    return number("post_id")


def _ranges_hit(ids: DataFrame, ranges: list) -> list:
    """Numbers of the ranges that ids fall into: at most as many as there are ranges."""
    if not ranges:
        return []
    return sorted(r[0] for r in ids.select(_range_of([r.low for r in ranges]).alias("n")).distinct().collect())


def read_posts_near(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The posts of all ranges that the ids (post_id) fall into: every post with one of these
    ids, and its neighbours."""
    _, ranges = _current(spark, path)
    return _read_folders(spark, path, [ranges[n].folder for n in _ranges_hit(ids, ranges)])


class Slice(NamedTuple):
    """Ids from `low` up to the next slice's; the last has no end."""

    low: str
    high: str | None

    def holds(self, rows: DataFrame) -> DataFrame:
        """The rows (post_id) of this slice; the first slice has those without an id."""
        if self.low:
            rows = rows.where(F.col("post_id") >= self.low)
        if self.high is not None:
            below = F.col("post_id") < self.high
            rows = rows.where(below if self.low else below | F.col("post_id").isNull())
        return rows

    def meets(self, low: str, high: str | None) -> bool:
        """Whether ids from low up to high may lie in it."""
        return (self.high is None or low < self.high) and (high is None or self.low < high)

    def covers(self, low: str, high: str | None) -> bool:
        """Whether all ids from low up to high lie in it."""
        return self.low <= low and (self.high is None or (high is not None and high <= self.high))


def archive_slices(spark: SparkSession, path: str) -> list[Slice]:
    """The ids in slices with about as much text of the archive each, SLICES at most and none below
    RANGE_BYTES. They begin where ranges do, but a range larger than two slices is cut."""
    ranges = _current(spark, path)[1]
    sizes = [r.rows * RANGE_BYTES // RANGE_ROWS if r.size is None else r.size for r in ranges]
    share = max(RANGE_BYTES, sum(sizes) / SLICES)
    lows, filled = [""], 0
    for r, size in zip(ranges, sizes):
        if filled >= share:
            lows.append(r.low)
            filled = 0
        filled += size
        if size >= 2 * share:
            lows += _cuts(_read_folders(spark, path, [r.folder]), int(size // share))
            filled = share
    lows = sorted(set(lows))
    return [Slice(*ends) for ends in zip(lows, [*lows[1:], None])]


def _cuts(posts: DataFrame, parts: int) -> list[str]:
    """Ids that cut posts into about equal parts."""
    spread = posts.where("post_id is not null").select("post_id").repartitionByRange(parts, "post_id").groupBy(F.spark_partition_id())
    return sorted(row.low for row in spread.agg(F.min("post_id").alias("low")).collect())[1:]


def slice_of(slices: list[Slice]) -> Column:
    """The number of the slice an id lies in."""
    return F.lit(0) if len(slices) == 1 else _range_of([s.low for s in slices])


UNCHECKED = object()


class VersionError(ValueError):
    """A version that may not be written."""


def write_posts(posts: DataFrame, path: str, version: str, clustered=False, base=UNCHECKED) -> None:
    """Write a whole version and publish it. A version that was published is never written again,
    as readers may still use it; one whose writing failed is.

    `base` names the version the posts were made from (None for none). If another one has
    been published since, nothing is published: its changes would be lost. The pointer is
    added without overwriting, so of two writers that add the same one, one fails.

    `clustered` lays the posts out by ranges of ids, so that updates rewrite only those they
    touch and id look-ups skip files. It costs a range shuffle, so it suits the first load.
    Without it the version is one range, which the first update splits.
    """
    spark = posts.sparkSession
    _refuse_published(spark, path, version)
    rows = posts.select(*[F.col(c).cast(POSTS[c].dataType) for c in POST_COLUMNS])
    if clustered:
        rows = stage(rows, "posts", lean=True)
        ranges = _write_ranges(rows, path, f"version={version}", [""], [""], 1, *_extent(rows))
        drop_stage(rows)
    else:
        save(rows, f"{_version_dir(path, version)}/whole", "overwrite")
        found = spark.read.schema(POSTS).parquet(f"{_version_dir(path, version)}/whole").agg(*map(F.expr, _FIGURES)).head()
        ranges = [Range("", f"version={version}/whole", found.n, _text(found.latest), found["size"])]
    _publish(spark, path, version, ranges, base)


EVERYTHING = Range("", None, 0, None, 0)
_BYTES = "coalesce(sum(octet_length(content)), 0)"
_FIGURES = [
    f"{figure} AS {name}"
    for figure, name in (("count(*)", "n"), ("max(created_at)", "latest"), ("min(post_id)", "low"), (_BYTES, "size"))
]


def _extent(posts: DataFrame) -> tuple[int, int]:
    """(number of posts, bytes of their texts)."""
    return tuple(posts.agg(F.count("*"), F.expr(_BYTES)).head())


def _text(time: datetime | None) -> str | None:
    return None if time is None else time.isoformat()


def write_changes(spark: SparkSession, path: str, version: str, changes: DataFrame, base=UNCHECKED) -> None:
    """Publish a version with `changes`, one row per post that is new or differs, put into the
    current one. Only the ranges they fall into are written anew; without changes none is."""
    update = Update(spark, path, version, base)
    for part in archive_slices(spark, path):
        update.put(part.holds(changes), part)
    update.publish()


class Update:
    """A version in the making. Changes are put into it slice by slice, and only the ranges they
    fall into are written anew; it counts once it is published."""

    def __init__(self, spark: SparkSession, path: str, version: str, base=UNCHECKED):
        _refuse_published(spark, path, version)
        self.spark, self.path, self.version, self.base = spark, path, version, base
        self.ranges = _current(spark, path)[1] or [EVERYTHING]
        self.highs = [*[r.low for r in self.ranges[1:]], None]
        #: Slices in which a range has no changes, for the case that it has some in another one.
        self.unchanged = {n: [] for n in range(len(self.ranges))}
        self.touched, self.new, self.written = set(), [], 0

    def put(self, changes: DataFrame, part: Slice) -> None:
        """Take the changes of a slice, one row per post that is new or differs."""
        touched = _ranges_hit(changes, self.ranges)
        if touched:
            before = self._read(touched, part)
            n_rows, n_bytes = map(sum, zip(_extent(changes), self._size(before, touched, part)))
            self._write(upsert(before, changes), touched, part, n_rows, n_bytes)
        self._unchanged(part, touched)

    def _unchanged(self, part: Slice, touched: list) -> None:
        for n, r in enumerate(self.ranges):
            if n not in touched and r.folder and part.meets(r.low, self.highs[n]):
                self.unchanged[n].append(part)

    def _read(self, numbers: list, part: Slice) -> DataFrame:
        return part.holds(_read_folders(self.spark, self.path, [self.ranges[n].folder for n in numbers if self.ranges[n].folder]))

    def _size(self, before: DataFrame, numbers: list, part: Slice) -> tuple[int, int]:
        """(posts, bytes of text) of the ranges' posts in a slice, from the pointer if it says so."""
        cut = any(not part.covers(self.ranges[n].low, self.highs[n]) for n in numbers)
        sizes = [self.ranges[n].size for n in numbers]
        return _extent(before) if cut or None in sizes else (sum(self.ranges[n].rows for n in numbers), sum(sizes))

    def _write(self, rows: DataFrame, numbers: list, part: Slice, n_rows: int, n_bytes: int) -> None:
        folder = f"version={self.version}/slice={self.written}"
        begins = [max(r.low, part.low) for r in self.ranges]
        self.new += _write_ranges(rows, self.path, folder, [r.low for r in self.ranges], begins, len(numbers), n_rows, n_bytes)
        self.touched |= set(numbers)
        self.written += 1

    def publish(self) -> None:
        for n in sorted(self.touched):
            for part in self.unchanged[n]:
                rows = self._read([n], part)
                self._write(rows, [n], part, *_extent(rows))
        ranges = [r for n, r in enumerate(self.ranges) if n not in self.touched and r.folder] + self.new
        _publish(self.spark, self.path, self.version, ranges, self.base)


def _write_ranges(rows: DataFrame, path: str, folder: str, lows: list, begins: list, touched: int, n_rows: int, n_bytes: int) -> list:
    """Write posts of some ranges below a new folder, each in one or several folders of RANGE_ROWS
    posts or RANGE_BYTES of text or so; the new ranges. Folders never mix posts of two ranges.
    `lows` are the bounds of the ranges, `begins` those of the posts given."""
    spark, target = rows.sparkSession, f"{path.rstrip('/')}/{folder}"
    pieces = max(touched, -(-n_rows // RANGE_ROWS), -(-n_bytes // RANGE_BYTES), 1)
    placed = rows.select(*[F.col(c).cast(POSTS[c].dataType) for c in POST_COLUMNS], _range_of(lows).alias("range"))
    laid_out = (
        placed.repartitionByRange(pieces, "range", "post_id").withColumn("piece", F.spark_partition_id())
        # In the order that partitionBy asks for, so that posts are sorted once.
        .sortWithinPartitions("range", "piece", "post_id")
    )
    save(laid_out, target, "overwrite", ["range", "piece"])
    written = spark.read.schema("post_id string, created_at timestamp_ntz, content string, range int, piece int").parquet(target)
    found = written.groupBy("range", "piece").agg(*map(F.expr, _FIGURES)).collect()
    new, seen = [], set()
    for row in sorted(found, key=lambda r: (r["range"], r.piece)):
        # The first folder of a range takes its bound, so that the ranges leave no gap.
        low = row.low if row["range"] in seen else begins[row["range"]]
        seen.add(row["range"])
        new.append(Range(low, f"{folder}/range={row['range']}/piece={row.piece}", row.n, _text(row.latest), row["size"]))
    return new


def _refuse_published(spark, path, version) -> None:
    if was_published(spark, path, version):
        raise VersionError(f"version {version} was published and may be in use")


def _publish(spark, path, version, ranges, base) -> None:
    step = max(_pointer_steps(spark, path, complete=False), default=0) + 1
    if base is not UNCHECKED and (now := current_version(spark, path)) != base:
        raise VersionError(f"version {version} was made from {base}, but {now} is current")
    lines = [{"version": version, **r._asdict()} for r in ranges] or [{"version": version}]
    pointer = spark.createDataFrame([(json.dumps(line),) for line in lines], "line string").coalesce(1)
    pointer.write.mode("error").text(f"{_pointer_dir(path)}/{step:010d}")

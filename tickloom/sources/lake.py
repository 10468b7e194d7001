"""The Parquet lake: year / month / day / symbol directories, compaction and retention.

All file work goes through Hadoop's FileSystem, so any store Spark can read works.
"""

from __future__ import annotations

import zlib
from datetime import date, datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.schemas import LAKE_PARTITION_FIELDS, LAKE_PARTITIONS

FILE_BYTES = 512 << 20


def with_date_partitions(df: DataFrame) -> DataFrame:
    """Add year, month and day of the event time (or of the time text where there is none)."""
    ts = F.col("event_ts") if "event_ts" in df.columns else F.try_to_timestamp("timestamp")
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def write_lake(df: DataFrame, base: str, mode: str = "append") -> None:
    """Write a table into the lake.

    Rows are gathered by directory so that a task writes few files; AQE splits a directory that is too
    big for one task, so a hot symbol's day becomes several files instead of one long task.
    """
    rows = with_date_partitions(df).hint("rebalance", *LAKE_PARTITIONS)
    rows.write.mode(mode).partitionBy(*LAKE_PARTITIONS).parquet(base)


write_raw_batch = write_lake
write_features_batch = write_lake


def read_lake(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame:
    """Read the lake from its root; directories become columns and symbols stay text ('007' is no number).

    ``schema`` (without the partition columns) saves the look into the files.
    """
    reader = spark.read
    if schema is None:
        schema = StructType([f for f in spark.read.parquet(base).schema.fields if f.name not in LAKE_PARTITIONS])
    else:
        schema = StructType([f for f in schema.fields if f.name not in LAKE_PARTITIONS])
    return reader.schema(StructType(schema.fields + LAKE_PARTITION_FIELDS)).parquet(base)


def on_date(day: date) -> Column:
    return (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)


def between_dates(first: date, last: date) -> Column:
    """Date range as a predicate on the partition columns, so other directories are not listed."""
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    as_number = [d.year * 10000 + d.month * 100 + d.day for d in (first, last)]
    years = F.col("year").between(first.year, last.year)
    return years & number.between(*as_number)


def read_partition(spark: SparkSession, base: str, day: date, symbol: str, schema: StructType | None = None) -> DataFrame:
    return read_lake(spark, base, schema).where(on_date(day) & (F.col("symbol") == symbol))


def read_reference(spark: SparkSession, path: str) -> DataFrame | None:
    """The reference sample, or None when none was saved yet."""
    return read_version(spark, path)


def write_reference(df: DataFrame, path: str) -> None:
    write_version(df, path)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of complete versions, oldest first."""
    if not path_exists(spark, path):
        return []
    names = sorted(name for name, is_dir, _ in _children(spark, path) if is_dir)
    return [_child(path, name) for name in names if path_exists(spark, _child(path, name, "_SUCCESS"))]


def write_version(df: DataFrame, path: str) -> None:
    """Replace a small table by writing a new folder beside the old one, which goes once the new one is complete."""
    spark, old = df.sparkSession, _versions(df.sparkSession, path)
    df.write.parquet(_child(path, datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")))
    for folder in old:
        _delete(spark, folder)


def read_version(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The newest complete version, or None while there is none."""
    found = _versions(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(found[-1]) if found else None


# --- file system ----------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def _child(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is directory, bytes) of the entries of a directory."""
    fs, where = _fs(spark, path)
    return [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(where)]


def _move(spark: SparkSession, source: str, target: str) -> bool:
    fs, source_path = _fs(spark, source)
    _, target_path = _fs(spark, target)
    fs.mkdirs(target_path.getParent())
    return fs.rename(source_path, target_path)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def _directories(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative paths of the directories ``depth`` levels below a path; none if it is missing."""
    if depth == 0:
        return [""]
    if not path_exists(spark, path):
        return []
    names = [name for name, is_dir, _ in _children(spark, path) if is_dir]
    return [_child(name, *filter(None, [rest])) for name in names for rest in _directories(spark, _child(path, name), depth - 1)]


def partition_path(spark: SparkSession, base: str, day: date, symbol: str) -> str | None:
    """The directory of a date and symbol; Spark writes special characters of a symbol as percent escapes."""
    parent = _child(base, f"year={day.year}", f"month={day.month}", f"day={day.day}")
    if not path_exists(spark, parent):
        return None
    names = [name for name, is_dir, _ in _children(spark, parent) if is_dir and unquote(name) == f"symbol={symbol}"]
    return _child(parent, names[0]) if names else None


def recover_compaction(spark: SparkSession, base: str, staging: str | None = None) -> list[str]:
    """Finish what a crash left half done: directories moved away and not replaced come back; return their paths."""
    staging, restored = staging or base.rstrip("/") + "_compaction", []
    for stamp in _directories(spark, staging, 1):
        for where in _directories(spark, _child(staging, stamp, "old"), 4):
            if not path_exists(spark, _child(base, where)):
                _move(spark, _child(staging, stamp, "old", where), _child(base, where))
                restored.append(_child(base, where))
        _delete(spark, _child(staging, stamp))
    return restored


def compact_partition(
    spark: SparkSession, base: str, day: date, symbol: str, staging: str | None = None, file_bytes: int = FILE_BYTES
) -> int:
    """Rewrite one date and symbol directory as few files of about ``file_bytes``; return its row count.

    The new files are written to a staging directory beside the lake and counted before the swap. The
    old directory is moved away first and deleted last; what a crash leaves half done, the next call or
    ``recover_compaction`` repairs. One compaction of a lake runs at a time.
    """
    staging = staging or base.rstrip("/") + "_compaction"
    recover_compaction(spark, base, staging)
    target = partition_path(spark, base, day, symbol)
    if target is None:
        raise FileNotFoundError(f"no rows of {symbol} on {day} in {base}")
    where = target[len(base.rstrip("/")) + 1 :]
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    fresh, old = _child(staging, stamp, "new", where), _child(staging, stamp, "old", where)

    size = sum(length for _, is_dir, length in _children(spark, target) if not is_dir)
    rows = spark.read.parquet(target)
    before = rows.count()
    rows.coalesce(max(1, -(-size // file_bytes))).write.parquet(fresh)
    after = spark.read.parquet(fresh).count()
    if after != before:
        raise RuntimeError(f"compaction of {target} wrote {after} of {before} rows; nothing was replaced")
    if not _move(spark, target, old):
        raise RuntimeError(f"could not move {target} away")
    if not _move(spark, fresh, target):
        _move(spark, old, target)
        raise RuntimeError(f"could not move the compacted files to {target}")
    _delete(spark, _child(staging, stamp))
    spark.catalog.refreshByPath(base)
    return after


def append_batch(df: DataFrame, base: str, batches: str, batch: int) -> None:
    """Append a numbered batch to the lake once, however often it is tried.

    The rows are written to a folder of the batch below ``batches`` and their files moved into the lake
    under names that carry ``batches`` and the number. A batch that was tried before first loses what it
    had moved; one that was completed is skipped.
    """
    spark = df.sparkSession
    folder, done = _child(batches, str(batch)), _child(batches, f"{batch}.done")
    if path_exists(spark, done):
        return
    name = f"{zlib.crc32(batches.encode()):08x}-{batch:010d}-"
    write_lake(df, folder, "overwrite")
    for where in _directories(spark, folder, len(LAKE_PARTITIONS)):
        target = _child(base, where)
        if path_exists(spark, target):
            for old, _, _ in _children(spark, target):
                if old.startswith(name):
                    _delete(spark, _child(target, old))
        files = sorted(f for f, is_dir, _ in _children(spark, _child(folder, where)) if not is_dir and f.endswith(".parquet"))
        for number, file in enumerate(files):
            if not _move(spark, _child(folder, where, file), _child(target, f"{name}{number:05d}.parquet")):
                raise RuntimeError(f"could not move {file} of batch {batch} to {target}")
    fs, mark = _fs(spark, done)
    fs.create(mark, True).close()
    _delete(spark, folder)


def retention_candidates(partitions: DataFrame, reference: Column, days: int = 90) -> DataFrame:
    """Dates among the rows' year, month and day that are older than the retention time."""
    dates = partitions.select(F.make_date("year", "month", "day").alias("partition_date")).distinct()
    return dates.where(F.col("partition_date") < F.date_sub(reference, days))


def _dated_directories(spark: SparkSession, base: str) -> list[tuple[date, str]]:
    """Directories year=/month=/day= below the root; names of other forms are ignored."""

    def level(path: str, name: str) -> list[tuple[int, str]]:
        found = []
        for child, is_dir, _ in _children(spark, path):
            key, _, value = child.partition("=")
            if is_dir and key == name and value.isdigit():
                found.append((int(value), _child(path, child)))
        return sorted(found)

    dated = []
    for year, year_path in level(base, "year"):
        for month, month_path in level(year_path, "month"):
            for day, day_path in level(month_path, "day"):
                try:
                    dated.append((date(year, month, day), day_path))
                except ValueError:
                    continue
    return dated


def apply_retention(
    spark: SparkSession, base: str, days: int = 90, reference: date | None = None, dry_run: bool = False
) -> list[str]:
    """Delete day directories older than ``days`` before ``reference`` (today by default); return their paths."""
    if not path_exists(spark, base):
        return []
    cutoff = (reference or datetime.now(timezone.utc).date()) - timedelta(days=days)
    outdated = [path for day, path in _dated_directories(spark, base) if day < cutoff]
    if not dry_run:
        for path in outdated:
            fs, where = _fs(spark, path)
            fs.delete(where, True)
    return outdated

"""Tables that change: commits that only one writer can make, and Parquet files replaced whole (copy on write).

``CommitLog`` is a folder of numbered JSON files. A number is created once or not at all, so of two writers that saw the same
state one must look again; no lock is held. ``SnapshotTable`` keeps rows in Parquet files that never change. A commit
names a manifest, itself a Parquet table with one row per live file and the bounds of its rows; a reader that has
the manifest of a commit sees that state, whatever is written meanwhile.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.sources.lake import _child, _children, _delete, _fs, path_exists
from tickloom.sources.scratch import settled

_DIGITS = 20


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless it is there; exactly one of several writers gets True."""
    fs, target = _fs(spark, path)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    fs.mkdirs(target.getParent())
    _, source = _fs(spark, temporary)
    out = fs.create(source, True)
    out.write(text.encode())
    out.close()
    try:
        if fs.getScheme() == "file":  # a rename would replace the file, a link does not
            os.link(source.toUri().getPath(), target.toUri().getPath())
            return True
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(source, target, options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(source, False)


class CommitLog:
    """Numbered commits, from 1; each is one JSON object."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, number: int) -> str:
        return _child(self.path, f"{number:0{_DIGITS}d}.json")

    def numbers(self) -> list[int]:
        if not path_exists(self.spark, self.path):
            return []
        names = (name.partition(".") for name, is_dir, _ in _children(self.spark, self.path) if not is_dir)
        return sorted(int(stem) for stem, _, ending in names if ending == "json" and stem.isdigit())

    def latest(self) -> int:
        return max(self.numbers(), default=0)

    def read(self, number: int) -> dict:
        fs, where = _fs(self.spark, self._file(number))
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def rows(self, schema: str, upto: int | None = None) -> DataFrame:
        """The commits up to a number as rows."""
        files = [self._file(n) for n in self.numbers() if upto is None or n <= upto]
        return self.spark.read.schema(schema).json(files) if files else self.spark.createDataFrame([], schema)

    def try_commit(self, number: int, content: dict) -> bool:
        return create_once(self.spark, self._file(number), json.dumps(content))

    def commit(self, build: Callable[[int], dict | None]) -> int:
        """Commit what ``build`` makes of the state after the given number, anew each time another writer was first.

        Returns the number of the commit, or of the last one where ``build`` finds nothing to do.
        """
        while True:
            last = self.latest()
            content = build(last)
            if content is None:
                return last
            if self.try_commit(last + 1, content):
                return last + 1


class SnapshotTable:
    """Rows known by ``key``, stored in ranges of ``order``, that can be added and changed."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str] = ("id",), order: Sequence[str] = ("symbol", "timestamp", "id")
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order = list(key), list(order)
        self.log = CommitLog(spark, _child(self.path, "_commits"))

    # --- reading ---

    def files(self, version: int | None = None) -> DataFrame | None:
        """The live files of a version with ``path``, ``n`` and the bounds ``min_c``, ``max_c`` of each column of the order."""
        version = self.log.latest() if version is None else version
        return self.spark.read.parquet(_child(self.path, self.log.read(version)["manifest"])) if version else None

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """The rows of a version, the newest by default; ``where`` picks files by their bounds, not rows."""
        files = self.files(version)
        if files is None:
            return self._of([])
        return self._of([r["path"] for r in (files if where is None else files.where(where)).select("path").collect()])

    def _of(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(_child(self.path, p) for p in sorted(paths)))

    # --- writing ---

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """New files in a folder of their own, in ranges of the order, and their part of a manifest."""
        folder = f"data/{uuid.uuid4().hex}"
        names = [f.name for f in self.schema.fields]
        ranged = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields)).repartitionByRange(*self.order)
        ranged.sortWithinPartitions(*self.order).select(*names).write.parquet(_child(self.path, folder))
        bounds = [f(c).alias(f"{name}_{c}") for c in self.order for name, f in (("min", F.min), ("max", F.max))]
        stored = self.spark.read.schema(self.schema).parquet(_child(self.path, folder))
        file = F.element_at(F.split(F.input_file_name(), "/"), -1)
        return folder, stored.groupBy(F.concat(F.lit(f"{folder}/"), file).alias("path")).agg(F.count(F.lit(1)).alias("n"), *bounds)

    def _commit(self, last: int, rows: DataFrame, replaced: list[str], operation: str) -> bool:
        folder, added = self._write(rows)
        manifest = f"_manifests/{uuid.uuid4().hex}"
        live = self.files(last)
        if live is not None:
            gone = self.spark.createDataFrame([(p,) for p in replaced], "path string")
            added = live.join(gone, "path", "left_anti").unionByName(added)
        added.coalesce(1).write.parquet(_child(self.path, manifest))  # one row per file
        if self.log.try_commit(last + 1, {"manifest": manifest, "operation": operation, "replaced": len(replaced)}):
            return True
        _delete(self.spark, _child(self.path, folder))
        _delete(self.spark, _child(self.path, manifest))
        return False

    def append(self, rows: DataFrame) -> int:
        """Add rows whose keys are new; returns the number of the commit."""
        rows = settled(rows)
        while not self._commit(last := self.log.latest(), rows, [], "append"):
            pass
        return last + 1

    def upsert(self, changes: DataFrame) -> int:
        """Replace the rows that have the keys of ``changes``, add the others; returns the newest commit's number.

        Only files that hold such a key are written anew: bounds leave most files out, the keys of the rest are read. If
        another writer commits first, all is done again on the new state. Without changes there is no commit. ``changes``
        has one row per key.
        """
        changes = settled(changes.select(*(f.name for f in self.schema.fields)))
        wanted = changes.agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{name}_{c}") for c in self.order for name, f in (("min", F.min), ("max", F.max)))).first()
        if not wanted["n"]:
            return self.log.latest()
        while True:
            last = self.log.latest()
            touched: list[str] = []
            if last:
                near = [(F.col(f"min_{c}") <= F.lit(wanted[f"max_{c}"])) & (F.col(f"max_{c}") >= F.lit(wanted[f"min_{c}"])) for c in self.key]
                held = self.read(last, where=_all(near)).select(*self.key, F.input_file_name().alias("_file"))
                files = held.join(changes.select(*self.key), self.key, "left_semi").select("_file").distinct().collect()
                touched = ["/".join(unquote(r["_file"]).split("/")[-3:]) for r in files]
            if self._commit(last, self._merged(self._of(touched), changes), touched, "upsert"):
                return last + 1

    def _merged(self, old: DataFrame, changes: DataFrame) -> DataFrame:
        untouched = old.join(changes.select(*self.key), self.key, "left_anti")
        return untouched.select(*changes.columns).unionByName(changes)

    def expire(self, keep: int = 1) -> int:
        """Delete the files that none of the newest ``keep`` versions holds; returns how many folders and manifests went.

        Not for use while a writer is between its files and its commit.
        """
        versions = self.log.numbers()[-keep:]
        contents = [self.log.read(n)["manifest"] for n in versions]
        live = {r["path"].rsplit("/", 1)[0] for n in versions for r in self.files(n).select("path").collect()}
        gone = 0
        for parent, used in (("data", live), ("_manifests", set(contents))):
            if path_exists(self.spark, _child(self.path, parent)):
                for name, _, _ in _children(self.spark, _child(self.path, parent)):
                    if f"{parent}/{name}" not in used:
                        _delete(self.spark, _child(self.path, parent, name))
                        gone += 1
        return gone


def _all(conditions: list[Column]) -> Column:
    found = conditions[0]
    for c in conditions[1:]:
        found = found & c
    return found

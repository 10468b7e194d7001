"""Stored steps of long jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.scratch import new_folder, removed, settled

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows as a stored table in the shared folder; shuffle files that made it are dropped once it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return settled(df, path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


class Steps:
    """Stored tables that are needed only until the result of a block is stored: they are deleted when it ends.

    ``with Steps(spark) as step:`` - ``step(df)`` stores a table for the block, ``step.over(df)`` ends one earlier.
    Whatever the block returns must be stored by ``kept``, or read none of them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark)
        table = kept(df, path)
        self.paths[id(table)] = table, path
        return table

    def over(self, *tables: DataFrame) -> None:
        for table in tables:
            if id(table) in self.paths:
                removed(self.spark, self.paths.pop(id(table))[1])

    def __enter__(self) -> Steps:
        return self

    def __exit__(self, *error: object) -> None:
        self.over(*(table for table, _ in list(self.paths.values())))

"""Intermediate tables that several later steps read: computed once, kept in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    named = spark.conf.get(DIR_CONF, "") or spark.sparkContext.getConf().get(DIR_CONF, "")
    master = spark.sparkContext.master
    if not named and (master == "local" or master.startswith("local[")):  # one machine, no other executors
        named = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set(DIR_CONF, named)
    if not named:
        raise RuntimeError(f"set {DIR_CONF} to a folder all executors share")
    return named.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A folder nobody has used, among those of the application."""
    return f"{shared_dir(spark)}/tickloom-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def settled(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rows as Parquet and read them back.

    Later steps scan the columns they need instead of repeating the work, a lost executor costs nothing,
    and Catalyst knows the exact size. The files live as long as the application's folder is kept.
    """
    spark = df.sparkSession
    path = path or new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

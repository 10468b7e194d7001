"""Register of the queries: a name, the Spark form and, where it can be said, the SQL form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StructType, TimestampType

from tickloom.plans.fixtures import Tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the fixture tables under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(build(Tables(spark, sf_dir)))

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def presented(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Output form of every query: times without zone, integers as long, doubles rounded to six digits."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StructType) and field.dataType.names == ["start", "end"]:
            for part in ("start", "end"):
                columns.append(c[part].cast("timestamp_ntz").alias(f"{field.name}_{part}"))
            continue
        if isinstance(field.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, IntegralType):
            c = c.cast("long")
        elif isinstance(field.dataType, DoubleType) and field.name not in exact:
            c = F.round(c + F.lit(0.00000001234567), 6)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    from tickloom.plans import drift_queries, evaluation_queries, monitor_queries, prediction_queries, tick_queries  # noqa: F401

"""Model versions as an append-only log of stage changes, folded to the current state when read.

Log columns: model, version, stage, test_rmse (nullable), tags (map), at, seq (settles equal times).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ordered import first_rows, last_rows
from tickloom.sources.snapshots import CommitLog

STAGING, PRODUCTION, ARCHIVED = "Staging", "Production", "Archived"
LOG_SCHEMA = (
    "model string, version long, stage string, test_rmse double, tags map<string,string>, at timestamp, seq long"
)
LOG_ORDER = ["at", "seq"]


def stage_fold(log: DataFrame) -> DataFrame:
    """Current stage of every version, after archiving what a later promotion replaced.

    A version in production is archived by the next promotion of another version of the model.
    """
    latest = last_rows(log, ["model", "version"], LOG_ORDER)
    newest = first_rows(
        log.where(F.col("stage") == PRODUCTION), ["model"], [F.col(c).desc() for c in LOG_ORDER]
    ).select("model", F.col("version").alias("_newest"), F.struct(*LOG_ORDER).alias("_since"))
    replaced = (F.col("stage") == PRODUCTION) & (F.col("version") != F.col("_newest"))
    return latest.join(newest, "model", "left").select(
        "model",
        "version",
        F.when(replaced, ARCHIVED).otherwise(F.col("stage")).alias("stage"),
        "test_rmse",
        F.when(replaced, F.col("_since.at")).otherwise(F.col("at")).alias("updated_at"),
        "seq",
    )


def production_version(log: DataFrame) -> DataFrame:
    """The version in production per model: the one whose state changed last. Models without one have no row."""
    live = stage_fold(log).where(F.col("stage") == PRODUCTION)
    return last_rows(live, ["model"], ["updated_at", "seq"]).select("model", "version", "test_rmse", "updated_at")


Event = tuple[int, str, float | None, dict[str, str]]  # version, stage, error, tags


class VersionLog:
    """The log as numbered commits. Every change is one commit, made from the state it follows; nothing is rewritten.

    Of two writers at once one finds its number taken and makes its change anew, so that versions are never given twice and
    a promotion archives what is live when it is committed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.log = CommitLog(spark, path)

    def read(self, upto: int | None = None) -> DataFrame:
        """All events, or those up to a commit."""
        events = self.log.rows(f"events array<struct<{LOG_SCHEMA}>>", upto)
        return events.select(F.explode("events").alias("e")).select("e.*")

    def _change(self, model: str, build: Callable[[DataFrame], list[Event]]) -> list[Event]:
        """Commit the events that ``build`` makes of the model's log so far; returns them."""
        made: list[Event] = []

        def content(last: int) -> dict:
            log = self.read(last).where(F.col("model") == model)
            seq = log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
            made[:] = build(log)
            now = datetime.now(timezone.utc).isoformat()
            return {
                "events": [
                    {"model": model, "version": v, "stage": stage, "test_rmse": rmse, "tags": tags, "at": now, "seq": seq + i}
                    for i, (v, stage, rmse, tags) in enumerate(made, 1)
                ]
            }

        self.log.commit(content)
        return made

    def register(self, model: str, rmse: float | None = None, /, **tags: object) -> int:
        """Add a version with its held-out error in Staging and return its number."""

        def new(log: DataFrame) -> list[Event]:
            last = log.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
            return [(last + 1, STAGING, rmse, {k: str(v) for k, v in tags.items()})]

        return self._change(model, new)[0][0]

    def promote(self, model: str, version: int, canary: bool = False) -> int:
        """Move a version to Production and archive the others; a canary tag is set before and cleared after."""

        def moved(log: DataFrame) -> list[Event]:
            rmse = last_rows(log.where(F.col("version") == version), ["model"], LOG_ORDER).select("test_rmse").first()
            if rmse is None:
                raise ValueError(f"{model} has no version {version}")
            live = stage_fold(log).where((F.col("stage") == PRODUCTION) & (F.col("version") != version))
            events: list[Event] = [(r["version"], ARCHIVED, r["test_rmse"], {}) for r in live.collect()]  # at most one
            if canary:
                events.append((version, STAGING, rmse[0], {"canary": "true"}))
            return [*events, (version, PRODUCTION, rmse[0], {"canary": "false"} if canary else {})]

        self._change(model, moved)
        return version

    def production_rmse(self, model: str) -> float | None:
        row = production_version(self.read().where(F.col("model") == model)).select("test_rmse").first()
        return row[0] if row else None

    def tags(self, model: str, version: int) -> dict[str, str]:
        """Tags of a version, later values over earlier ones."""
        rows = self.read().where((F.col("model") == model) & (F.col("version") == version))
        entry = rows.select(F.explode("tags").alias("k", "v"), *LOG_ORDER)
        newest = first_rows(entry, ["k"], [F.col(c).desc() for c in LOG_ORDER])
        return {r["k"]: r["v"] for r in newest.select("k", "v").collect()}

    def gate(self, model: str, report: dict, canary: bool = False, save: Callable[[int], str] | None = None) -> dict:
        """Register a trained model; promote it only when its report says promotable and it has been saved.

        ``save`` stores the model under its version number and returns the place, which the log keeps.
        If it fails nothing is promoted.
        """
        version = self.register(
            model,
            report["test_rmse"],
            test_rmse=report["test_rmse"],
            beats_baseline=report["beats_baseline"],
            promotable=report["promotable"],
        )
        if save is not None:
            place = save(version)
            self._change(model, lambda _: [(version, STAGING, report["test_rmse"], {"location": place})])
        if report["promotable"]:
            self.promote(model, version, canary)
        status = "promoted" if report["promotable"] else "staging_only"
        return {"model": model, "version": version, "status": status, "promotable": report["promotable"]}

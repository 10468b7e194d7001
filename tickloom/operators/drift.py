"""Drift of features and of prediction errors against a reference sample: PSI and Kolmogorov-Smirnov.

``current`` may carry key columns (e.g. symbol). Each key is compared with the one shared reference;
the reference is never copied per key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import smirnov_p_value
from tickloom.operators.ordered import Ordering, carried, cut, finish, first_rows
from tickloom.schemas import MODEL_FEATURES
from tickloom.sources.scratch import settled

# Bins, share of an empty bin, thresholds, smallest samples.
BINS = 10
EMPTY_SHARE = 1e-10
PSI_LIMIT = 0.2
ALPHA = 0.05
MIN_VALUES = 2
MIN_ERRORS = 4
FEW = 100_000  # distinct current values that every task may hold


def shared_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns both sides have, in the reference's order."""
    return [c for c in reference.columns if c in current.columns]


def to_long(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, feature, value); NULL and NaN values are left out."""
    wide = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features])
    long = wide.unpivot(list(keys), list(features), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(
    reference: DataFrame, current: DataFrame, keys: Sequence[str] = (), by: Sequence[str] = ("feature",)
) -> DataFrame:
    """How often each value occurs on either side, as a stored table: all tests below are sums over it."""
    no_key = [F.lit(None).cast(current.schema[k].dataType).alias(k) for k in keys]
    both = reference.select(*no_key, *by, "value", F.lit(True).alias("is_ref")).unionByName(
        current.select(*keys, *by, "value", F.lit(False).alias("is_ref"))
    )
    return settled(both.groupBy(*keys, *by, "value", "is_ref").agg(F.count(F.lit(1)).alias("n")))


def _sides(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return counts.where("is_ref"), counts.where("not is_ref")


def _per_group(df: DataFrame, by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Side of a join with one row per group. One row per feature column is always few; else ask Catalyst."""
    return F.broadcast(df) if tuple(by) == ("feature",) and not keys else df


def _edges(reference: DataFrame, by: Sequence[str]) -> DataFrame:
    """Lowest value and width of ten equal bins between the reference's extremes, one row per feature."""
    span = reference.groupBy(*by).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    span = span.withColumns(
        {
            "_lo": F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
            "_hi": F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")),
        }
    )
    return span.withColumn("_step", (F.col("_hi") - F.col("_lo")) / BINS)


def _binned(counts: DataFrame, edges: DataFrame, by: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """Counts per bin; values outside the edges fall into no bin but stay in the total."""
    placed = counts.join(_per_group(edges, by), list(by))
    value, lo, hi, step = F.col("value"), F.col("_lo"), F.col("_hi"), F.col("_step")
    passed = sum((F.when(value >= lo + step * i, 1).otherwise(0) for i in range(1, BINS)), F.lit(0))
    placed = placed.withColumn("_bin", F.when(value.between(lo, hi), passed))
    here = [F.sum(F.when(F.col("_bin") == i, F.col("n")).otherwise(0)).alias(f"_{name}_{i}") for i in range(BINS)]
    return placed.groupBy(*keys, *by).agg(F.sum("n").alias(f"n_{name}"), *here)


def _psi(left: str, right: str) -> Column:
    def share(side: str, i: int) -> Column:
        count = F.col(f"_{side}_{i}")
        return F.when(count == 0, EMPTY_SHARE).otherwise(count / F.col(f"n_{side}"))

    terms = [(share(right, i) - share(left, i)) * F.ln(share(right, i) / share(left, i)) for i in range(BINS)]
    return sum(terms[1:], terms[0])


def psi(counts: DataFrame, keys: Sequence[str] = (), by: Sequence[str] = ("feature",)) -> DataFrame:
    """Population stability index per ``keys`` of the current side and ``by`` of both."""
    reference, current = _sides(counts)
    edges = _edges(reference, by)
    ref = _binned(reference, edges, by, (), "ref")
    cur = _binned(current, edges, by, keys, "cur")
    joined = cur.join(_per_group(ref, by), list(by))
    return joined.select(*keys, *by, "n_ref", "n_cur", _psi("ref", "cur").alias("psi"))


def ks(counts: DataFrame, keys: Sequence[str] = (), by: Sequence[str] = ("feature",)) -> DataFrame:
    """Largest distance between the two distribution functions, and its asymptotic p-value.

    The distance peaks at or just before a current value, so the reference's function is only looked up
    there: the values of both sides stand in one order per feature, the reference's first among equal ones, and
    are counted along, the reference's over all keys and the current ones per key.
    """
    reference, current = _sides(counts)
    is_ref = F.col("is_ref")
    rows = cut(counts.withColumn("_cur", (~is_ref).cast("int")), by, ["value", "_cur"])
    of_ref = {"_ref_upto": ("sum", F.when(is_ref, F.col("n")).otherwise(0)), "_ref_value": ("last", F.when(is_ref, F.col("value"))), "_ref_n": ("last", F.when(is_ref, F.col("n")))}
    rows = carried(rows, of_ref)
    rows = carried(replace(rows, keys=(*keys, *by)), {"_upto": ("sum", F.when(is_ref, 0).otherwise(F.col("n")))})
    at_value = F.when(F.col("_ref_value") == F.col("value"), F.col("_ref_n")).otherwise(0)
    own = finish(rows).where(~is_ref).select(*keys, *by, "_ref_upto", "_upto", F.col("n").alias("_here"), at_value.alias("_ref"))
    n_ref = reference.groupBy(*by).agg(F.sum("n").alias("n_ref"))
    n_cur = current.groupBy(*keys, *by).agg(F.sum("n").alias("n_cur"))
    return _distance(own, n_ref, n_cur, keys, by)


def _distance(own: DataFrame, n_ref: DataFrame, n_cur: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The largest distance from the counts up to and at each current value."""
    met = own.join(_per_group(n_ref, by), list(by)).join(_per_group(n_cur, by, keys), [*keys, *by])
    at = F.abs(F.col("_ref_upto") / F.col("n_ref") - F.col("_upto") / F.col("n_cur"))
    before = F.abs(
        (F.col("_ref_upto") - F.col("_ref")) / F.col("n_ref") - (F.col("_upto") - F.col("_here")) / F.col("n_cur")
    )
    worst = met.groupBy(*keys, *by, "n_ref", "n_cur").agg(F.max(F.greatest(at, before)).alias("ks_statistic"))
    n1, n2 = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    return worst.withColumn("ks_p_value", smirnov_p_value(F.col("ks_statistic"), n1, n2))


def _few_values(current: DataFrame) -> dict[str, np.ndarray] | None:
    """The distinct current values of each feature in ascending order, or None if there are more than ``FEW``."""
    rows = current.select("feature", "value").distinct().limit(FEW + 1).collect()
    if len(rows) > FEW:
        return None
    found: dict[str, list[float]] = {}
    for feature, value in rows:
        found.setdefault(feature, []).append(value)
    return {feature: np.sort(np.array(values)) for feature, values in found.items()}


def _reference_steps(reference: DataFrame, features: Sequence[str], marks: dict[str, np.ndarray]) -> DataFrame:
    """``feature, value, upto_n, at_n``: the reference's values from above the mark before to each mark, and at it.

    Values above the last mark have a NULL one. A task gives a row for each mark at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto = {f: np.zeros(len(marks.get(f, ())) + 1, np.int64) for f in features}
        equal = {f: np.zeros(len(marks.get(f, ())) + 1, np.int64) for f in features}
        for batch in batches:
            for f in features:
                values = batch.column(f).to_numpy(zero_copy_only=False)
                values = values[~np.isnan(values)]
                ends = np.append(marks.get(f, np.zeros(0)), np.nan)
                place = np.searchsorted(ends[:-1], values)
                upto[f] += np.bincount(place, minlength=len(ends))
                equal[f] += np.bincount(place[ends[place] == values], minlength=len(ends))
        for f in features:
            seen = np.flatnonzero(upto[f])
            ends = np.append(marks.get(f, np.zeros(0)), np.nan)[seen]
            columns = [pa.array([f] * len(seen), pa.string()), pa.array(ends, mask=np.isnan(ends)), pa.array(upto[f][seen]), pa.array(equal[f][seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "upto_n", "at_n"])

    wide = reference.select(*[F.col(f).cast("double").alias(f) for f in features])
    found = wide.mapInArrow(run, "feature string, value double, upto_n long, at_n long")
    return found.groupBy("feature", "value").agg(F.sum("upto_n").alias("upto_n"), F.sum("at_n").alias("at_n"))


def _ks_of_few(
    reference: DataFrame, features: Sequence[str], current: DataFrame, keys: Sequence[str], marks: dict[str, np.ndarray]
) -> DataFrame:
    """``ks`` where ``current`` has few distinct values: the reference is counted between them and never sorted."""
    by = ["feature"]
    steps = settled(_reference_steps(reference, features, marks))
    none = F.lit(0).cast("long")
    every = steps.where("value is not null").unionByName(current.select(*by, "value", none.alias("upto_n"), none.alias("at_n")))
    here = every.groupBy(*by, "value").agg(F.sum("upto_n").alias("upto_n"), F.sum("at_n").alias("_ref"))
    ordered = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)  # at most FEW rows
    function = here.select(*by, "value", "_ref", F.sum("upto_n").over(ordered.partitionBy(*by)).alias("_ref_upto"))
    own = current.withColumn("_upto", F.sum("n").over(ordered.partitionBy(*keys, *by))).withColumnRenamed("n", "_here")
    n_ref = steps.groupBy(*by).agg(F.sum("upto_n").alias("n_ref"))
    n_cur = current.groupBy(*keys, *by).agg(F.sum("n").alias("n_cur"))
    return _distance(own.join(function, [*by, "value"]), n_ref, n_cur, keys, by)


def compare(
    counts: DataFrame,
    keys: Sequence[str] = (),
    by: Sequence[str] = ("feature",),
    psi_limit: float = PSI_LIMIT,
    alpha: float = ALPHA,
) -> DataFrame:
    """PSI and KS side by side with a ``drifted`` flag; groups with fewer than two values on a side drop out."""
    return _flagged(psi(counts, keys, by), ks(counts, keys, by), keys, by, psi_limit, alpha)


def _flagged(by_bins: DataFrame, by_distance: DataFrame, keys: Sequence[str], by: Sequence[str], psi_limit: float, alpha: float) -> DataFrame:
    both = by_bins.join(by_distance.drop("n_ref", "n_cur"), [*keys, *by])
    enough = (F.col("n_ref") >= MIN_VALUES) & (F.col("n_cur") >= MIN_VALUES)
    return both.where(enough).withColumn("drifted", (F.col("ks_p_value") < alpha) | (F.col("psi") > psi_limit))


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    keys: Sequence[str] = (),
    features: Sequence[str] | None = None,
    psi_limit: float = PSI_LIMIT,
    alpha: float = ALPHA,
) -> DataFrame:
    """Compare every shared feature column of two wide tables.

    With few distinct values on the current side, as of the newest rows of each symbol, the reference is read for its
    extremes, its bins and its counts between those values, and should be a stored table; else both sides are sorted.
    """
    features = list(features or [c for c in shared_columns(reference, current) if c not in keys])
    own = settled(to_long(current, features, keys).groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n")))
    marks = _few_values(own)
    no_key = [F.lit(None).cast(current.schema[k].dataType).alias(k) for k in keys]
    one_each = to_long(reference, features).select(*no_key, "feature", "value", F.lit(True).alias("is_ref"), F.lit(1).cast("long").alias("n"))
    both = one_each.unionByName(own.withColumn("is_ref", F.lit(False)))
    if marks is None:
        counts = settled(both.groupBy(*keys, "feature", "value", "is_ref").agg(F.sum("n").alias("n")))
        return compare(counts, keys, ("feature",), psi_limit, alpha)
    return _flagged(psi(both, keys), _ks_of_few(reference, features, own, keys, marks), keys, ("feature",), psi_limit, alpha)


def concept_drift(
    errors: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp", "id"),
    error: str = "realized_return_error",
    newest_is_reference: bool = False,
    psi_limit: float = PSI_LIMIT,
    alpha: float = ALPHA,
) -> DataFrame:
    """Compare the older half of each key's error series with the newer half.

    Keys with fewer than four errors get no row. ``newest_is_reference`` swaps the halves (and puts an
    odd middle value accordingly), as when the series is handed over newest first.
    """
    known = errors.where(F.col(error).isNotNull()).select(*keys, *order, F.col(error).cast("double").alias("value"))
    halves = halves_in_time(known, keys, order, newest_is_reference).where(F.col("n_rows") >= MIN_ERRORS)
    counts = settled(halves.groupBy(*keys, "value", F.col("is_reference").alias("is_ref")).agg(F.count(F.lit(1)).alias("n")))
    return compare(counts, (), tuple(keys), psi_limit, alpha)


# --- report, cooldown, state ----------------------------------------------------------------------


def drift_summary(features: DataFrame, concept: DataFrame | None = None, key: str = "symbol") -> DataFrame:
    """One row per key: did features drift, which ones, did the errors drift."""
    entry = F.struct("feature", "psi", "ks_statistic", "ks_p_value")
    report = features.groupBy(key).agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("feature_drift"),
        F.count_if("drifted").alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), entry))).alias("drifted_columns"),
    )
    if concept is None:
        return report.withColumn("concept_drift", F.lit(False))
    flags = concept.select(key, F.col("drifted").alias("_errors"))
    # A key may have errors but too few feature values, or the other way round.
    both = report.join(flags, key, "full")
    nothing = F.array().cast(report.schema["drifted_columns"].dataType)
    return both.select(
        key,
        F.coalesce("feature_drift", F.lit(False)).alias("feature_drift"),
        F.coalesce("n_drifted", F.lit(0)).cast("long").alias("n_drifted"),
        F.coalesce("drifted_columns", nothing).alias("drifted_columns"),
        F.coalesce("_errors", F.lit(False)).alias("concept_drift"),
    )


def with_cooldown(report: DataFrame, state: DataFrame, now: Column, minutes: int = 30, key: str = "symbol") -> DataFrame:
    """Trigger a retrain where drift was found and the key's last trigger is long enough ago."""
    joined = report.join(state.select(key, "last_trigger_time"), key, "left")
    last = F.col("last_trigger_time")
    waiting = last.isNotNull() & (now < last + F.make_dt_interval(mins=F.lit(minutes)))
    drift = F.col("feature_drift") | F.col("concept_drift")
    return joined.withColumns({"cooldown_active": waiting, "triggered": drift & ~waiting}).withColumn(
        "last_trigger_time", F.when(F.col("triggered"), now).otherwise(last)
    )


def upsert_state(state: DataFrame, changes: DataFrame, key: str = "symbol") -> DataFrame:
    """The state table after the changes: the changed row where there is one, the old row elsewhere."""
    columns = [key, "last_trigger_time"]
    both = state.select(*columns, F.lit(0).alias("_newer")).unionByName(changes.select(*columns, F.lit(1).alias("_newer")))
    return first_rows(both, [key], [F.col("_newer").desc(), F.col("last_trigger_time").desc()]).drop("_newer")


def any_triggered(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_or("triggered"), F.lit(False)).alias("retrain"))


def drift_report(
    reference: DataFrame,
    recent_features: DataFrame,
    recent_errors: DataFrame,
    state: DataFrame,
    now: Column,
    minutes: int = 30,
    key: str = "symbol",
) -> DataFrame:
    """The whole check for all symbols in one job."""
    features = feature_drift(reference, recent_features, (key,), MODEL_FEATURES)
    errors = concept_drift(recent_errors, (key,))
    return with_cooldown(drift_summary(features, errors, key), state, now, minutes, key)


def reference_sample(features: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of symbol and time: the same ones however the table is stored."""
    text = F.concat_ws("|", F.lit(str(seed)), "symbol", F.unix_micros("event_ts").cast("string"))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1_000_000
    return features.where(place < round(fraction * 1_000_000)).select(*MODEL_FEATURES)


def halves_in_time(
    df: DataFrame | Ordering, keys: Sequence[str], order: Sequence[str], newest: bool = False
) -> DataFrame:
    """Flag the older (or the ``newest``) half of each key's rows as the reference; adds ``n_rows`` per key.

    ``df`` may be rows in slices of these keys and this order.
    """
    rows = df if isinstance(df, Ordering) else cut(df, keys, order)
    total = rows.df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    numbered = finish(carried(rows, {"_k": ("sum", F.lit(1))}, reverse=newest))
    joined = numbered.join(total, list(keys))
    return joined.withColumn("is_reference", F.col("_k") <= F.floor(F.col("n_rows") / 2)).drop("_k")

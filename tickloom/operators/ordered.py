"""Ordered work per key that survives a hot key.

A window partitioned by symbol puts all rows of a symbol into one task. When one symbol holds a third
of a 100 TB table that task never ends. ``cut`` range-partitions the rows by key and order, sorts each
partition and stores it with its number and every row's place in it: a *slice*, rows of a key that are
consecutive in the wanted order. What a slice needs from its neighbours is carried over separately, so
results do not depend on where the cuts fall (float sums and products but for rounding):

* ``framed``  - frames that look a fixed number of rows back or ahead. Each slice gets copies of the few
  rows before and after it, which their places tell apart from the others.
* ``carried`` - aggregates over everything before a row. Each slice gets the totals of the slices before it.
* ``first_rows`` / ``last_rows`` - top rows per key; Spark limits each map task first, so no slices.
* ``values_at_ranks`` - exact order statistics of a whole table without sorting it.

Both window forms partition by key and slice, so that steps on the same slices share one exchange and one
sort; only ``cut`` stores. The number of slices is Spark's number of shuffle partitions, fewer where adaptive
execution joins small ones. The input runs twice, once for the sample that sets the ranges and once to be stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.sources.scratch import settled

SLICE, PLACE, HALO = "_slice", "_place", "_halo"
_PLACE_BITS = 33  # of the row numbers that Spark counts up within a partition


@dataclass(frozen=True)
class Ordering:
    """Rows with their order inside ``keys`` and the number of their slice; also their place in it, straight from ``cut``."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def groups(self) -> list[str]:
        return [*self.keys, SLICE]

    def window(self, reverse: bool = False) -> WindowSpec:
        return Window.partitionBy(*self.groups).orderBy(*_sorted(self.order, reverse))

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Ordering:
        """Other columns or fewer rows, in the same slices."""
        return replace(self, df=change(self.df))


def _sorted(order: Sequence[str], reverse: bool = False) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Ordering:
    """Store the rows in slices; a slice may hold the rows of several keys, or a part of one key's."""
    by = [*keys, *order]
    place = F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1)
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias(SLICE), place.alias(PLACE))
    return Ordering(settled(ranged), tuple(keys), tuple(order))


def finish(rows: Ordering) -> DataFrame:
    return rows.df.drop(SLICE, PLACE)


def bounded_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Apply ``add`` (which appends window columns) with frames of at most ``before``/``after`` rows."""
    return finish(framed(cut(df, keys, order), before, after, add))


def framed(rows: Ordering, before: int, after: int, add: Callable[[DataFrame, WindowSpec], DataFrame]) -> Ordering:
    """The same for rows that come straight from ``cut``; the result keeps the slices."""
    plain = rows.df.select("*", F.lit(False).alias(HALO))
    with_halo = plain.drop(PLACE).unionByName(_neighbour_rows(rows, before, after))
    return replace(rows, df=add(with_halo, rows.window()).where(~F.col(HALO)).drop(HALO))


def _neighbour_rows(rows: Ordering, before: int, after: int) -> DataFrame:
    """Copies of the rows up to ``before`` places ahead of each slice and ``after`` behind it.

    Neighbours are counted over all keys; rows of another key form windows of their own and leave with the copies.
    """
    sizes = dict(rows.df.groupBy(SLICE).count().collect())  # one row per slice
    slices = sorted(sizes)
    # Slice that needs rows, slice that has them, first and last place; one that meets nothing keeps the plan alike for any number.
    wanted: list[tuple[int, int, int, int]] = [(-1, -1, 0, 0)]
    for at, target in enumerate(slices):
        missing, back = before, at - 1
        while missing > 0 and back >= 0:
            source = slices[back]
            wanted.append((target, source, max(sizes[source] - missing, 0), sizes[source] - 1))
            missing, back = missing - sizes[source], back - 1
        missing, ahead = after, at + 1
        while missing > 0 and ahead < len(slices):
            source = slices[ahead]
            wanted.append((target, source, 0, min(sizes[source], missing) - 1))
            missing, ahead = missing - sizes[source], ahead + 1
    columns = [pa.array(c, pa.int64()) for c in zip(*wanted)]
    edges = rows.df.sparkSession.createDataFrame(pa.table(columns, names=["_target", "_source", "_first", "_last"]))
    # A few rows per slice.
    met = rows.df.join(F.broadcast(edges), (F.col(SLICE) == F.col("_source")) & F.col(PLACE).between(F.col("_first"), F.col("_last")))
    own = [c for c in rows.df.columns if c not in (SLICE, PLACE)]
    return met.select(*own, F.col("_target").cast("int").alias(SLICE), F.lit(True).alias(HALO))


# How each running aggregate is computed in a frame, and how a carried value joins a local one.
_AGGREGATES: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda carried, local: carried + local),
    "product": (F.product, lambda carried, local: carried * local),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carried, local: local),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    reverse: bool = False,
) -> DataFrame:
    """Add aggregates over all rows up to and including the current one.

    ``columns`` maps the new name to (kind, input); kinds are sum, product, max, min and last (last
    non-null value). ``reverse`` runs from the end, so ``last`` then finds the next value ahead.
    """
    return finish(carried(cut(df, keys, order), columns, reverse))


def carried(rows: Ordering, columns: dict[str, tuple[str, Column]], reverse: bool = False) -> Ordering:
    """As ``running``, for rows in slices; the result keeps them, so that more can be added to it."""
    frame = rows.window(reverse).rowsBetween(Window.unboundedPreceding, 0)
    local = {name: _AGGREGATES[kind][0](value).over(frame) for name, (kind, value) in columns.items()}
    place = F.struct(*rows.order)
    totals = []
    for name, (kind, value) in columns.items():
        if kind == "last":
            pick = F.min_by if reverse else F.max_by
            totals.append(pick(value, F.when(value.isNotNull(), place)).alias(f"_sum_{name}"))
        else:
            totals.append(_AGGREGATES[kind][0](value).alias(f"_sum_{name}"))
    per_slice = rows.df.groupBy(*rows.groups).agg(*totals)
    slices = Window.partitionBy(*rows.keys).orderBy(*_sorted([SLICE], reverse))
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(
        *[F.col(g).alias(f"_at_{g}") for g in rows.groups],
        *[_AGGREGATES[kind][0](F.col(f"_sum_{n}")).over(earlier).alias(f"_carry_{n}") for n, (kind, _) in columns.items()],
    )
    joined = rows.df.withColumns(local).join(
        before, [F.col(g).eqNullSafe(F.col(f"_at_{g}")) for g in rows.groups], "left"
    )
    total = {}
    for name, (kind, _) in columns.items():
        here, carry = F.col(name), F.col(f"_carry_{name}")
        total[name] = (
            F.when(carry.isNull(), here).when(here.isNull(), carry).otherwise(_AGGREGATES[kind][1](carry, here))
        )
    helpers = [f"_at_{g}" for g in rows.groups] + [f"_carry_{n}" for n in columns]
    return replace(rows, df=joined.withColumns(total).drop(*helpers))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key. Spark keeps at most ``n`` per key in each map task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The last ``n`` rows per key in ascending ``order``."""
    return first_rows(df, keys, _sorted(order, reverse=True), n)


_BUCKETS = 16_384
_FEW_ROWS = 4_096


def values_at_ranks(
    df: DataFrame, column: str, ranks: Callable[[int], list[int]], stored: bool = False
) -> tuple[int, list[int]]:
    """Exact values at 0-based positions of a timestamp column in ascending order, in microseconds.

    Narrows each position down by bucket counts, so a pass returns some thousand counts to the driver
    and nothing is sorted. The column is written once before the passes unless ``df`` is ``stored``
    already. ``ranks`` receives the number of non-null rows; (count, values) is returned.
    """
    values = df.select(F.unix_micros(column).alias("v"))
    values = values if stored else settled(values)
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    wanted = [min(max(r, 0), n - 1) for r in ranks(n)] if n else []
    found: dict[int, int] = {}
    spans = {(low, high): (0, n)} if n else {}  # span -> (rows before it, rows in it)
    inside = {(low, high): sorted(set(wanted))} if n else {}
    while inside:
        bucket = F.lit(None)
        for number, (lo, hi) in enumerate(inside):
            few = spans[lo, hi][1] <= _FEW_ROWS or hi - lo < _BUCKETS
            width = 1 if few else (hi - lo) // _BUCKETS + 1
            offset = F.expr(f"(v - ({lo})) div {width}")
            bucket = F.when(
                F.col("v").between(lo, hi),
                F.struct(F.lit(number).alias("span"), F.lit(width).cast("long").alias("width"), offset.alias("at")),
            ).otherwise(bucket)
        counts = values.select(bucket.alias("b")).where("b is not null").groupBy("b").count().collect()
        spans_next: dict[tuple[int, int], tuple[int, int]] = {}
        inside_next: dict[tuple[int, int], list[int]] = {}
        for number, (lo, hi) in enumerate(inside):
            todo, seen = list(inside[lo, hi]), spans[lo, hi][0]
            for b, count in sorted((r for r in counts if r[0]["span"] == number), key=lambda r: r[0]["at"]):
                here = [r for r in todo if seen <= r < seen + count]
                start = lo + b["at"] * b["width"]
                if here and b["width"] == 1:
                    found.update((r, start) for r in here)
                elif here:
                    span = (start, min(hi, start + b["width"] - 1))
                    spans_next[span], inside_next[span] = (seen, count), here
                seen += count
        spans, inside = spans_next, inside_next
    return n, [found[r] for r in wanted]


"""Order-dependent columns without pulling a whole series into one task.

A plain window over a series puts all its rows into one task. Here all rows are numbered in order first, by one range sort in which an arrival number
breaks ties, and cut into ranges of an equal number of rows; so a range is bounded also where all positions are equal. The window runs inside
(series, range), and one summary row per series and range carries the state across ranges. The summaries of a long series are ranges again, level upon level, until few are left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.session import materialize

_MIN_ROWS = 50_000  # per range, so that a small frame stays in one piece
FAN = 10_000  # ranges of a level that one window may carry across


def with_range(
    frame: DataFrame, order: str | list[str], buckets: int | None = None, min_rows: int = _MIN_ROWS, fan: int = FAN
) -> DataFrame:
    """Add `_range` and `_number`: the place of a row in ``order``, and which range of about ``min_rows`` rows it is in.

    Rows equal in ``order`` are numbered as they arrive; name further columns there where this matters. The number of ranges grows with the
    rows; ``buckets`` bounds it, for callers that know their rows to be few. ``fan`` says how many ranges are carried across at a time.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows = frame.count()
    ranges = max(1, ceil(rows / max(1, min_rows)))
    ranges = ranges if buckets is None else min(ranges, buckets)
    if ranges == 1:
        numbered, place = frame.withColumn("_number", F.monotonically_increasing_id()), F.lit(0).cast("bigint")
    else:
        tied = frame.withColumn("_tie", F.monotonically_increasing_id())
        numbered = number_rows(tied.orderBy(*order, "_tie"), 0, "_number").drop("_tie")
        place = F.floor(F.col("_number") / F.lit(ceil(rows / ranges)))
    return numbered.withColumn("_range", place.alias("_range", metadata={"ranges": ranges, "fan": fan}))


@dataclass(frozen=True)
class _Fold:
    """How a value is carried: over the rows before, over a whole range, and of two parts, the earlier one first."""

    before: Callable[[str], Column]
    whole: Callable[[str, str], Column]
    merge: Callable[[Column, Column], Column]


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


_LAST = _Fold(F.last, lambda value, at: F.max_by(value, at), lambda a, b: F.coalesce(b, a))
_FOLDS = {
    "sum": _Fold(F.sum, lambda value, at: F.sum(value), _plus),
    "max": _Fold(F.max, lambda value, at: F.max(value), lambda a, b: F.greatest(a, b)),
}


def _meet(rows: DataFrame, parts: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``parts``; a null series meets itself."""
    named = parts.withColumnsRenamed({c: f"_of_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on]
    return rows.join(named, same).drop(*[f"_of_{c}" for c in on])


def _carried(parts: DataFrame, series: list[str], fold: _Fold, ranges: int, fan: int) -> DataFrame:
    """``parts`` (series, `_range`, `_total`), one row per series and range, with `_carry`: the fold of the ranges before."""
    if ranges <= fan:
        earlier = Window.partitionBy(*series).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        return parts.select(*series, "_range", fold.before("_total").over(earlier).alias("_carry"))
    lifted = parts.withColumn("_upper", F.floor(F.col("_range") / F.lit(fan)))
    inside = Window.partitionBy(*series, "_upper").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = lifted.groupBy(*series, "_upper").agg(fold.whole("_total", "_range").alias("_total")).withColumnRenamed("_upper", "_range")
    above = _carried(tops, series, fold, ceil(ranges / fan), fan).withColumnsRenamed({"_range": "_upper", "_carry": "_above"})
    joined = _meet(lifted.withColumn("_inside", fold.before("_total").over(inside)), above, [*series, "_upper"])
    return joined.select(*series, "_range", fold.merge(F.col("_above"), F.col("_inside")).alias("_carry"))


def _across(ranged: DataFrame, rows: DataFrame, parts: DataFrame, series: list[str], fold: _Fold) -> DataFrame:
    cut = ranged.schema["_range"].metadata
    return _meet(rows, _carried(parts, series, fold, cut["ranges"], cut["fan"]), [*series, "_range"])


def lagged(ranged: DataFrame, series: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Add `prev_<column>` from the row before in its series (null for the first)."""
    row = F.struct(*columns)
    order = [*order, "_number"]
    inside = Window.partitionBy(*series, "_range").orderBy(*order)
    tails = ranged.groupBy(*series, "_range").agg(F.max_by(row, F.struct(*order)).alias("_total"))
    joined = _across(ranged, ranged.withColumn("_prev", F.lag(row).over(inside)), tails, series, _LAST)
    before = _LAST.merge(F.col("_carry"), F.col("_prev"))
    return joined.select(*ranged.columns, *[before[c].alias(f"prev_{c}") for c in columns])


def running(
    ranged: DataFrame, series: list[str], order: list[str], value: Column, how: str, name: str, current: bool = True
) -> DataFrame:
    """Running `sum` or `max` of ``value``; without ``current`` only the rows before count."""
    fold = _FOLDS[how]
    frame = ranged.withColumn("_value", value)
    inside = Window.partitionBy(*series, "_range").orderBy(*order, "_number").rowsBetween(
        Window.unboundedPreceding, 0 if current else -1
    )
    totals = frame.groupBy(*series, "_range").agg(fold.whole("_value", "_number").alias("_total"))
    joined = _across(ranged, frame.withColumn("_inside", fold.before("_value").over(inside)), totals, series, fold)
    return joined.select(*ranged.columns, fold.merge(F.col("_carry"), F.col("_inside")).alias(name))


def number_rows(batch: DataFrame, first: int, name: str = "record_seq") -> DataFrame:
    """Dense numbers from ``first``. Each partition counts its rows; the running total over partitions
    (one row each) gives its base, so no row is sorted or moved. ``batch`` is stored before, so that a
    repeated task sees the same rows."""
    tagged = materialize(batch.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_mid", 33)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return tagged.withColumn("_part", part).join(bases, "_part").withColumn(
        name, (F.lit(first) + F.col("_base") + within).cast("bigint")
    ).drop("_part", "_base", "_mid")


def ranked_within(rows: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 within their group, by one range sort over all rows: no task holds a whole group."""
    numbered = number_rows(rows.orderBy(*group, *order), 0, "_number")
    first = numbered.groupBy(*group).agg(F.min("_number").alias("_first"))
    placed = numbered.join(first, group).withColumn(name, (F.col("_number") - F.col("_first") + 1).cast("int"))
    return placed.drop("_number", "_first")

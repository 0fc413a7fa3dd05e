"""As-of joins: the last earlier row of a key for every row of another table.

Both sides go into one table, sorted by key and time, in which a value is carried forward
to the rows after it. No row meets more than the one that it takes, so nothing is paired
and filtered. Rows of a key over the limit are dealt to several tasks as consecutive
stretches of the sorted table, and each stretch starts from the last value before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import require_columns
from tallyline.operators.trailing import MAX_ROWS_PER_TASK
from tallyline.session import materialize

_POINT, _TIME, _ORDER, _VALUE, _ROW, _PART = "_is_point", "_time", "_order", "_value", "_row", "_part"


def _present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _carried(rows: DataFrame, keys: Sequence[str], start: Column | None = None) -> DataFrame:
    """Points with the last value before them in their window, else with ``start``."""
    before = Window.partitionBy(*keys).orderBy(*_sorted()).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(_VALUE, ignorenulls=True).over(before)
    return rows.withColumn(_VALUE, last if start is None else F.coalesce(last, start)).filter(_POINT)


def _sorted() -> list[Column]:
    """Points come before values of the same time: a value counts strictly after its time."""
    return [F.col(_TIME), F.col(_POINT).desc(), F.col(_ORDER)]


def _in_stretches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of hot keys, sorted over all tasks. A key then lies in consecutive parts;
    what a part starts from is the last value in the parts of its key before it."""
    # The row's number makes the order total, so that equal rows need not share a task.
    # Both steps are written: a part is what one task held, which must not change.
    numbered = materialize(rows.withColumn(_ROW, F.monotonically_increasing_id()), "asof")
    dealt = numbered.repartitionByRange(*keys, *_sorted(), F.col(_ROW))
    parts = materialize(dealt.withColumn(_PART, F.spark_partition_id()), "asof-parts")
    values = parts.filter(~F.col(_POINT))
    newest = F.max_by(F.col(_VALUE), F.struct(_TIME, _ORDER, _ROW)).alias("_newest")
    ends = values.groupBy(*keys, _PART).agg(newest)
    # A row a part and key: the parts of a key are few, and keys in many parts are rare.
    starts = parts.select(*keys, _PART).distinct().join(ends, [*keys, _PART], "left")
    along = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.last("_newest", ignorenulls=True).over(along)).drop("_newest")
    begun = parts.join(starts, [*keys, _PART])
    return _carried(begun, [*keys, _PART], F.col("_start")).drop("_start", _PART, _ROW)


def join_as_of(
    points: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    point_time: str,
    value_order: Sequence[str],
    columns: Sequence[str],
    *,
    max_rows_per_task: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``points`` with ``columns`` of the last row of ``values`` of the same key whose first
    column of ``value_order`` lies strictly before ``point_time``; the other columns of the
    order decide between rows of one time. A point without such a row, or with a missing key
    or time, keeps NULL; a missing value of the chosen row stays missing. Rows of ``values``
    without a key or time are never chosen. The order should be total; where it is not,
    which of several equal rows is chosen is open.

    One aggregate job looks for keys with more rows than a task should hold, of points and
    values together; only those are sorted over several tasks. ``max_rows_per_task=None``
    skips it for keys whose size is known to be bounded."""
    keys = list(keys)
    require_columns(points, [*keys, point_time], "as-of points")
    require_columns(values, [*keys, *value_order, *columns], "as-of values")
    kept = points.columns
    if clash := set(columns) & set(kept):
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    known = values.filter(_present([*keys, value_order[0]]))
    chosen = F.struct(*columns)
    order = F.struct(*value_order)
    time_type = known.schema[value_order[0]].dataType
    order_type = known.select(order.alias(_ORDER)).schema[_ORDER].dataType
    chosen_type = known.select(chosen.alias(_VALUE)).schema[_VALUE].dataType
    point = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)])
    point_type = points.select(point.alias("_point")).schema["_point"].dataType
    able = _present([*keys, point_time])
    left = points.filter(able).select(
        *keys,
        F.col(point_time).cast(time_type).alias(_TIME),
        F.lit(True).alias(_POINT),
        F.lit(None).cast(order_type).alias(_ORDER),
        point.alias("_point"),
        F.lit(None).cast(chosen_type).alias(_VALUE),
    )
    right = known.select(
        *keys,
        F.col(value_order[0]).alias(_TIME),
        F.lit(False).alias(_POINT),
        order.alias(_ORDER),
        F.lit(None).cast(point_type).alias("_point"),
        chosen.alias(_VALUE),
    )
    rows = left.unionByName(right)
    if max_rows_per_task is None:
        found = _carried(rows, keys)
    else:
        rows = materialize(rows, "asof-rows")
        hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows_per_task)
        # At most the number of rows divided by the limit.
        hot = materialize(hot.select(*keys), "hot-keys")
        found = _carried(rows.join(hot, keys, "left_anti"), keys)
        if not hot.isEmpty():
            found = found.unionByName(_in_stretches(rows.join(hot, keys, "left_semi"), keys))
    taken = [F.col(f"_point._{i}").alias(c) for i, c in enumerate(kept)]
    joined = found.select(*taken, *[F.col(f"{_VALUE}.{c}").alias(c) for c in columns])
    missing = {c: F.lit(None).cast(known.schema[c].dataType) for c in columns}
    return joined.unionByName(points.filter(~able).withColumns(missing))

"""First or last event after an anchor, and rows inside an interval, over two tables.

Both are joins with an inequality on dates. Written as such, every pair of a key's rows is made
and then dropped. Here the events (or intervals) of a key are gathered into one sorted array,
combined before the shuffle, which the number of different dates bounds; the other table is joined
to it on the key alone, and looks its date up in the array.

The larger table is shuffled once. Its key is joined together with a hash of it: so the join asks
for exchanges of its own on both sides, which adaptive execution can split where one key holds a
large part of the rows (a side that an aggregation has dealt out already cannot be split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.dates import month_diff_sql


def _joined(rows: DataFrame, arrays: DataFrame, key: str) -> DataFrame:
    """``rows`` with the array ``_held`` of their key (null without one)."""
    left = rows.withColumn("_hash", F.xxhash64(key))
    right = arrays.withColumn("_hash", F.xxhash64(key))
    return left.join(right, [key, "_hash"], "left").drop("_hash")


def event_after(
    anchors: DataFrame,
    events: DataFrame,
    key: str,
    anchor: str,
    event: str,
    name: str = "event_date",
    which: str = "first",
    inclusive: bool = False,
    months: int | None = None,
) -> DataFrame:
    """``anchors`` with column ``name``: the first (or last) date ``event`` of the same key's
    ``events`` after the date ``anchor``.

    ``inclusive`` counts the anchor's own date too; ``months`` asks for at least so many month
    boundaries between both instead. A row without an anchor, a key or such an event gets null."""
    if which not in ("first", "last"):
        raise ValueError(f"which must be 'first' or 'last', got {which!r}")
    dates = events.where(F.col(key).isNotNull() & F.col(event).isNotNull()).groupBy(key)
    arrays = dates.agg(F.array_sort(F.collect_set(event)).alias("_held"))
    if months is not None:
        after = f"{month_diff_sql(f'`{anchor}`', 'd')} >= {int(months)}"
    else:
        after = f"d {'>=' if inclusive else '>'} `{anchor}`"
    found = f"filter(_held, d -> {after})"
    chosen = F.expr(f"try_element_at({found}, {1 if which == 'first' else -1})")
    rest = [c for c in anchors.columns if c != name]
    return _joined(anchors.select(*rest), arrays, key).select(*rest, chosen.alias(name))


def rows_in_interval(
    points: DataFrame, intervals: DataFrame, key: str, point: str, start: str, end: str, how: str = "left", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``points`` with ``start``, ``end`` and the columns ``keep`` of each interval of the same key
    that holds the date ``point`` (both ends count). With ``how="left"`` a point in no interval
    stays, with nulls; with ``"inner"`` it goes. Equal intervals count once."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    taken = [start, end, *keep]
    clash = [c for c in taken if c in points.columns]
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(clash)}")
    some = intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    held = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(taken)])
    arrays = some.groupBy(key).agg(F.array_sort(F.collect_set(held)).alias("_held"))
    inside = F.expr(f"filter(_held, i -> `{point}` >= i.c0 AND `{point}` <= i.c1)")
    explode = F.explode_outer if how == "left" else F.explode
    found = _joined(points, arrays, key).select(*points.columns, explode(inside).alias("_one"))
    columns: list[Column] = [F.col(f"_one.c{i}").alias(c) for i, c in enumerate(taken)]
    return found.select(*points.columns, *columns)

"""Ordering questions over all stores at once, without one window over all rows.

Rows are shuffled into ranges of the order they are asked in, a range per partition. Each range
is looked at by itself; what it has to know of the ranges before or after it is one row per
range, which is carried over. Ranges are cut by what is there, not by the clock, and the order
goes down to single rows, so a moment with a third of all rows is cut as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstream.operators.ranking import in_ranges

TXN = ["date_time", "trans_id"]

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, 0)


def _carried(rows: DataFrame, by: list[str], column: str, forward: bool) -> DataFrame:
    """(by, range, carried): the nearest ``column`` in the ranges before, or (forward) after.

    One row per range, and per group of ``by`` in it.
    """
    pick, order = (F.min, F.desc("range")) if forward else (F.max, F.asc("range"))
    beyond = Window.partitionBy(*by).orderBy(order).rowsBetween(*_BEFORE)
    return (
        rows.groupBy(*by, "range").agg(pick(column).alias("own"))
        .select(*by, "range", pick("own").over(beyond).alias("carried"))
    )


def _with_carried(rows: DataFrame, carried: DataFrame, by: list[str]) -> DataFrame:
    names = {c: f"_{c}" for c in [*by, "range"]}
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items() if c != "range"]
    return rows.join(
        carried.withColumnsRenamed(names), [F.col("range") == F.col("_range"), *same], "left"
    ).drop(*names.values())


def event_gaps(txns: DataFrame, by_store: bool = False) -> DataFrame:
    """Seconds between each transaction and the one before it.

    Order is (date_time, trans_id) over all stores, or per store. ``gap_seconds`` is in
    whole seconds, 0 for the first transaction and for all but the first of one moment.
    Rows of one transaction, such as its lines, count once; they are combined before they are
    shuffled. Undated transactions have no gap.
    """
    by = ["store_id"] if by_store else []
    own = [] if by_store else [F.min("store_id").alias("store_id")]
    if by_store:
        each = txns.select("store_id", *TXN).distinct()
    else:
        each = txns.groupBy(*TXN).agg(*own)
    rows = in_ranges(each, [*by, *TXN] if by_store else [*TXN, "store_id"])
    in_range = Window.partitionBy(*by, "range").orderBy(*TXN)
    before = rows.withColumn("before", F.lag("date_time").over(in_range))
    carried = _carried(rows, by, "date_time", forward=False)
    # An undated one, or one of the same moment, may be the last; neither makes a gap.
    last = F.coalesce("before", "carried")
    gap = F.coalesce(F.timestamp_diff("SECOND", last, "date_time"), F.lit(0))
    return _with_carried(before, carried, by).select(
        "store_id", *TXN, F.greatest(gap, F.lit(0)).alias("gap_seconds")
    )


def snapshot_times(snapshots: DataFrame) -> DataFrame:
    """The distinct (date_time, store_id) at which counts were taken, in time order."""
    return snapshots.select("date_time", "store_id").distinct().orderBy("date_time", "store_id")


def snapshot_release(
    snapshots: DataFrame, changes: DataFrame, by_store: bool = False
) -> DataFrame:
    """For each count (store, time): the time of the first change not before it.

    A count is sent just before that change. ``release_time`` is NULL where no change
    follows. Changes of any store release a count unless ``by_store`` is set.

    Counts and changes are put in one order, a change after the counts of its moment, and
    passed once from the end.
    """
    by = ["of_store"] if by_store else []
    of_store = [F.col("store_id").alias("of_store")] if by_store else []
    counts = snapshots.select(
        *of_store, "store_id", F.col("date_time").alias("time"), F.lit(None).cast("timestamp").alias("hit")
    )
    hits = changes.select(*of_store, F.col("date_time").alias("time"), F.col("date_time").alias("hit"))
    marks = counts.distinct().unionByName(
        hits.filter("time IS NOT NULL").distinct(), allowMissingColumns=True
    ).withColumn("is_hit", F.col("hit").isNotNull())
    order = ["time", "is_hit", "store_id"]
    rows = in_ranges(marks, [*by, *order, "hit"])
    from_end = Window.partitionBy(*by, "range").orderBy(*[F.desc(c) for c in order]).rowsBetween(*_SO_FAR)
    after = rows.withColumn("after", F.min("hit").over(from_end))
    # Counts without a time, or without a store where that matters, meet no change.
    meets = F.col("time").isNotNull()
    for c in by:
        meets &= F.col(c).isNotNull()
    release = F.when(meets, F.coalesce("after", "carried"))
    return _with_carried(after, _carried(rows, by, "hit", forward=True), by).filter(~F.col("is_hit")).select(
        "store_id", F.col("time").alias("date_time"), release.alias("release_time")
    )

"""Current inventory and its report form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstream.functions import or_zero, store_label
from shelfstream.operators.fanout import repeat_rows
from shelfstream.operators.ranking import numbered

STOCK_KEY = ["store_id", "item_id"]


def recent_changes(changes: DataFrame, latest: DataFrame) -> DataFrame:
    """Changes not before the oldest of the latest counts; no earlier one can matter.

    The bound is a scalar subquery. On a change table partitioned by ``event_date`` it
    prunes whole days of history before they are read.
    """
    oldest = latest.select(F.min("date_time")).scalar()
    recent = changes.filter(F.col("date_time") >= oldest)
    if "event_date" in changes.columns:
        oldest_day = latest.select(F.to_date(F.min("date_time"))).scalar()
        recent = recent.filter(F.col("event_date") >= oldest_day)
    return recent


def day_sums(changes: DataFrame) -> DataFrame:
    """What dated changes moved per (store, item, change type) and day, and when last."""
    return (
        changes.filter(F.col("date_time").isNotNull())
        .groupBy("store_id", "item_id", "change_type_id", F.to_date("date_time").alias("event_date"))
        .agg(F.sum("quantity").alias("moved"), F.max("date_time").alias("moved_at"))
    )


def _counts(latest: DataFrame) -> DataFrame:
    return latest.select(
        *STOCK_KEY, F.col("date_time").alias("counted_at"), F.col("quantity").alias("counted")
    )


def _movements(counted: DataFrame, effective: DataFrame) -> DataFrame:
    """Per (store, item): what moved at or after its count, and how much was counted.

    The count is unique per key, so the changes can be summed before they meet the outer
    join. A small table of counts is broadcast and the changes are summed where they are
    read. Beyond that both sides are shuffled by the key, the sums and the outer join reuse
    that partitioning, and a key with a large share of the changes is split by adaptive skew
    handling: an inner join may split either side, and
    ``spark.sql.adaptive.forceOptimizeSkewedJoin`` (see :mod:`shelfstream.session`) lets it do
    so although the sums of the splits then need a shuffle.
    """
    return (
        effective.join(_counts(counted), STOCK_KEY)
        .filter(F.col("date_time") >= F.col("counted_at"))
        .groupBy(*STOCK_KEY)
        .agg(
            F.sum("quantity").alias("moved"),
            F.max("date_time").alias("moved_at"),
            F.min("counted").alias("counted"),
        )
    )


def _movements_by_day(counted: DataFrame, sums: DataFrame, of_counted_days: DataFrame) -> DataFrame:
    """As :func:`_movements`, of whole days after the count and of changes on its day."""
    counts = _counts(counted).withColumn("counted_on", F.to_date("counted_at"))
    later = (
        sums.join(counts, STOCK_KEY).filter(F.col("event_date") > F.col("counted_on"))
        .select(*STOCK_KEY, "moved", "moved_at", "counted")
    )
    same_day = (
        of_counted_days.join(counts, STOCK_KEY)
        .filter((F.col("date_time") >= F.col("counted_at")) & (F.to_date("date_time") == F.col("counted_on")))
        .select(*STOCK_KEY, F.col("quantity").cast("bigint").alias("moved"),
                F.col("date_time").alias("moved_at"), "counted")
    )
    return later.unionByName(same_day).groupBy(*STOCK_KEY).agg(
        F.sum("moved").alias("moved"), F.max("moved_at").alias("moved_at"), F.min("counted").alias("counted")
    )


def changes_of_counted_days(changes: DataFrame, latest: DataFrame) -> DataFrame:
    """Changes on the days of the latest counts.

    The days are read first and become a list in the filter, at most one entry per calendar
    day: on a change table partitioned by ``event_date`` no other day is listed or read.
    """
    days = latest.select(F.to_date("date_time").alias("day")).distinct().filter("day IS NOT NULL")
    on = F.col("event_date") if "event_date" in changes.columns else F.to_date("date_time")
    return changes.filter(on.isin([r.day for r in days.collect()]))


def current_inventory(latest: DataFrame, effective: DataFrame) -> DataFrame:
    """Stock per (store, item): the latest count plus what moved at or after it.

    ``latest`` has one row per key. A key that was never counted has no row; one without
    a change keeps its count and the time of the count.

    ``latest`` is used twice with the same columns and rows, so that Spark reads and shuffles
    the counts under it once. Counts with a NULL in their key match no change and are added
    by a scan that keeps only them.
    """
    return _stock(latest, lambda counted: _movements(counted, effective))


def current_inventory_of_sums(
    latest: DataFrame, sums: DataFrame, of_counted_days: DataFrame
) -> DataFrame:
    """As :func:`current_inventory`, from sums per day and the changes of the counts' days.

    ``sums`` are effective :func:`day_sums`, ``of_counted_days`` effective changes, all those
    of the days on which a latest count was taken at least. The history before and between
    is not needed.
    """
    return _stock(latest, lambda counted: _movements_by_day(counted, sums, of_counted_days))


def _stock(latest: DataFrame, movements: Callable[[DataFrame], DataFrame]) -> DataFrame:
    has_key = F.col("store_id").isNotNull() & F.col("item_id").isNotNull()
    columns = [*STOCK_KEY, "quantity", "date_time"]
    counted = latest.filter(has_key).select(*columns)
    rest = latest.filter(~has_key).select(*columns)
    nothing = F.lit(None)
    moved = counted.join(movements(counted), STOCK_KEY, "left").unionByName(
        rest.withColumns({
            "moved": nothing.cast("bigint"),
            "moved_at": nothing.cast("timestamp"),
            "counted": nothing.cast("int"),
        })
    )
    change = or_zero("moved")
    count = F.coalesce("counted", "quantity")
    return moved.select(
        *STOCK_KEY,
        count.alias("snapshot_quantity"),
        change.alias("change_quantity"),
        (count + change).alias("current_inventory"),
        F.greatest("date_time", "moved_at").alias("date_time"),
    )


def newest_first(current: DataFrame) -> DataFrame:
    """Presentation order; a stored table is not sorted.

    The key decides between equal times, so that many equal ones spread over the sort.
    """
    return current.orderBy(*_newest_first())


def _newest_first() -> list[Column]:
    return [F.desc("date_time"), *[F.asc(c) for c in STOCK_KEY]]


def numbered_newest_first(current: DataFrame) -> DataFrame:
    """Each row with its place in the order of :func:`newest_first`, from 1 on, as ``position``."""
    return numbered(current, _newest_first())


def current_inventory_by_quantity(latest: DataFrame, effective: DataFrame) -> DataFrame:
    """Current inventory with the stock named ``current_quantity``, least stock first."""
    return (
        current_inventory(latest, effective)
        .withColumnRenamed("current_inventory", "current_quantity")
        .orderBy("current_quantity", *STOCK_KEY)
    )


def count_changes(changes: DataFrame) -> DataFrame:
    """Changes per (item, change type), as column ``n``; those of no item do not count."""
    return (
        changes.filter(F.col("item_id").isNotNull())
        .groupBy("item_id", "change_type_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def inventory_for_bi(
    current: DataFrame, changes: DataFrame, change_types: DataFrame, compact: bool = False
) -> DataFrame:
    """Current inventory repeated for each change of its item, in any store.

    Changes are counted per (item, change type) before anything is joined, and a row is
    repeated by that count at the very end. ``compact`` keeps the count as column ``n``
    instead. An item without changes has one row with a NULL change type.
    """
    return inventory_for_bi_of_counts(current, count_changes(changes), change_types, compact)


def inventory_for_bi_of_counts(
    current: DataFrame, counted: DataFrame, change_types: DataFrame, compact: bool = False
) -> DataFrame:
    """As :func:`inventory_for_bi`, of counts as :func:`count_changes` gives them.

    Several counts of one (item, change type) are added up.
    """
    by_type = (
        counted.join(
            change_types.select("change_type_id", "change_type"), "change_type_id", "left"
        )
        .groupBy("item_id", "change_type")
        .agg(F.sum("n").alias("n"))
    )
    rows = current.join(by_type, "item_id", "left").select(
        F.to_date("date_time").alias("date"),
        store_label("store_id").alias("store_id"),
        "item_id",
        "change_type",
        "current_inventory",
        "change_quantity",
        "snapshot_quantity",
        "date_time",
        F.coalesce("n", F.lit(1)).alias("n"),
    )
    if compact:
        return rows
    return repeat_rows(rows, F.col("n"), ["item_id", "store_id", "change_type"]).drop("n")


def distinct_items(items: DataFrame) -> DataFrame:
    """Number of distinct item ids."""
    return items.agg(F.count_distinct("item_id").alias("items"))

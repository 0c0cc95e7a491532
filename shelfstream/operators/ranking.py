"""The first row per key, and the place of each row in an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row that comes first in ``order`` for each key; NULL keys are one key.

    Spark keeps one row per key in each input partition before it shuffles (a window group
    limit), so a key with many rows sends at most one from each.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def in_ranges(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """``rows`` in ranges of ``order``, a range per partition, numbered by ``range`` from 0 on.

    ``order`` names all columns, so that readers of some columns share one shuffle. The number
    of ranges is that of shuffle partitions. It is given, so that adaptive execution does not
    join ranges, and each reader of them sees the same numbers.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())


def numbered(rows: DataFrame, order: list[Column], position: str = "position") -> DataFrame:
    """``rows`` with their place in ``order``, from 1 on; equal ones in any order.

    Each range of the order is numbered by itself and begins where the ranges before it end,
    of which only the sizes are brought together.
    """
    # Columns the order has already stay in front; the rest only makes both reads alike.
    ranged = in_ranges(rows, [*order, *rows.columns])
    sizes = ranged.groupBy("range").agg(F.count(F.struct(*rows.columns)).alias("_size"))
    up_to = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        F.col("range").alias("_range"), F.coalesce(F.sum("_size").over(up_to), F.lit(0)).alias("_before")
    )
    in_range = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return (
        ranged.withColumn(position, in_range).join(before, F.col("range") == F.col("_range"))
        .withColumn(position, (F.col(position) + F.col("_before")).cast("bigint"))
        .drop("range", "_range", "_before")
    )

"""Distinct items over a history, from sketches that can be merged.

Exact distinct counts of different spans do not add up, so each span is a pass over its history.
A sketch per day is a few kilobytes, and the sketch of any span of days is the union of theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketches have two to this power registers.
LG_REGISTERS = 12


def sketch_error(lg_registers: int = LG_REGISTERS, deviations: float = 3) -> float:
    """The share by which an estimate may be off, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_registers / 2)


def item_sketches(changes: DataFrame, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(event_date, items): a sketch of the items changed on each day.

    Several rows for one day, as when parts of the history are sketched apart, are merged by
    whoever reads them. Undated changes and those of no item are not counted.
    """
    return (
        changes.filter("date_time IS NOT NULL AND item_id IS NOT NULL")
        .groupBy(F.to_date("date_time").alias("event_date"))
        .agg(F.hll_sketch_agg("item_id", lg_registers).alias("items"))
    )


def distinct_items_of_sketches(sketches: DataFrame, unit: str) -> DataFrame:
    """(start, items): about how many items changed in each day, month, or other calendar unit."""
    return sketches.groupBy(_start(unit, "event_date")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("items")).alias("items")
    )


def distinct_items_by(changes: DataFrame, unit: str) -> DataFrame:
    """(start, items): how many items changed in each calendar unit, exactly."""
    dated = changes.filter("date_time IS NOT NULL AND item_id IS NOT NULL")
    return dated.groupBy(_start(unit, "date_time")).agg(F.count_distinct("item_id").alias("items"))


def _start(unit: str, column: str):
    return F.to_date(F.date_trunc(unit, column)).alias("start")

"""Repeating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies unrolled at a time, and copies made by a task, about.
BLOCK = 100_000
TASK_ROWS = 2_000_000


def repeat_rows(
    df: DataFrame, times: Column, spread_by: list[str], block: int | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Repeat each row ``times`` times; rows with a count below one or NULL disappear.

    A large count is first cut into blocks, and the blocks are shuffled apart before
    they are unrolled, so neither one array nor one task holds a whole group. How many tasks
    share them follows from the sum of all counts, which a first job adds up: adaptive
    execution would choose from the size before the fan-out. Fewer than the session's shuffle
    partitions they never are. ``spread_by`` should tell rows apart.
    """
    block, task_rows = block or BLOCK, task_rows or TASK_ROWS
    counted = df.withColumn("_times", times.cast("bigint")).filter(F.col("_times") >= 1)
    total = counted.agg(F.sum("_times")).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, -(-total // task_rows))
    return (
        counted.withColumn(
            "_block",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_times - 1) div {block}"))),
        )
        .repartition(partitions, *spread_by, "_block")
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(
                    F.lit(1).cast("bigint"),
                    F.least(
                        F.lit(block).cast("bigint"),
                        F.col("_times") - F.col("_block") * block,
                    ),
                )
            ),
        )
        .drop("_times", "_block", "_copy")
    )

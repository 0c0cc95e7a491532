"""Places in an order."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from shelfstream.operators.ranking import numbered


@pytest.mark.parametrize("n", [0, 1, 3, 500])
def test_rows_are_numbered_in_their_order(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 101).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("b"))
    got = numbered(df.repartition(5), [F.desc("a"), F.asc("b")])
    assert got.columns == ["a", "b", "position"]
    found = sorted(got.collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(1, n + 1))
    want = sorted(map(tuple, df.collect()), key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
    assert [(r.a, r.b) for r in found] == want


def test_only_sizes_meet_in_one_task(spark):
    df = spark.range(10_000).withColumn("b", F.col("id") % 7)
    plan = plan_of(numbered(df, [F.desc("b")])).split("== Initial Plan ==")[0]
    single = plan.split("Exchange SinglePartition")[1:]
    assert len(single) == 1 and re.search(r"HashAggregate\(keys=\[range", single[0].split("Exchange", 1)[0])
    assert "ReusedExchange" in plan

"""Rows repeated by a count."""

from collections import Counter

from pyspark.sql import functions as F

from shelfstream.operators.fanout import repeat_rows


def per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_appear_as_often_as_they_say(spark):
    rows = [(1, 0), (2, 1), (3, 7), (3, 7), (4, -2), (5, None), (6, 100)]
    df = spark.createDataFrame(rows, "id int, n int")
    want = Counter({2: 1, 3: 14, 6: 100})
    for options in ({}, {"block": 3}, {"block": 3, "task_rows": 5}):
        got = repeat_rows(df, F.col("n"), ["id"], **options)
        assert got.columns == ["id", "n"]
        assert Counter(r.id for r in got.collect()) == want


def test_no_rows(spark):
    assert repeat_rows(spark.createDataFrame([], "id int, n int"), F.col("n"), ["id"]).collect() == []


def test_tasks_follow_the_sum_of_the_counts(spark):
    """A fan-out of 100 times as much has 100 times the tasks, each with as much as before."""
    sizes = {}
    for fan_out in (100, 10_000):
        df = spark.range(400).withColumn("n", F.lit(fan_out))
        sizes[fan_out] = per_task(repeat_rows(df, F.col("n"), ["id"], block=250, task_rows=10_000))
        assert sum(sizes[fan_out]) == 400 * fan_out
        assert max(sizes[fan_out]) < 25_000
    assert len(sizes[10_000]) > 300


def test_one_row_with_nearly_all_copies_is_dealt_out(spark):
    df = spark.createDataFrame([(1, 500_000)] + [(k, 1) for k in range(2, 50)], "id int, n int")
    held = per_task(repeat_rows(df, F.col("n"), ["id"], block=1_000, task_rows=25_000))
    assert len(held) >= 18 and max(held) <= 50_000

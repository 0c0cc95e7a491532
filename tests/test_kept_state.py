"""What streams keep in their state, against the same over the whole history."""

import datetime as dt
import random
import re

import pytest
from conftest import at, plan_of, rows
from pyspark.sql import functions as F

from shelfstream import current_inventory, effective_changes, latest_snapshot, schemas
from shelfstream.operators.changes import effective_sums
from shelfstream.operators.inventory import (
    changes_of_counted_days,
    count_changes,
    current_inventory_of_sums,
    day_sums,
)
from shelfstream.operators.snapshots import SEQUENCE, SNAPSHOT_KEY, TIE_BREAK
from shelfstream.plans import (
    Layout,
    read_change_counts,
    read_day_sums,
    read_latest_snapshots,
    read_silver_changes,
    start_change_streams,
    start_snapshot_streams,
    streamed_inventory,
)
from shelfstream.sinks import to_envelope
from shelfstream.sources import read_change_stream
from shelfstream.operators.transactions import assemble_transactions, to_documents
from shelfstream.streaming import keep_latest, read_latest

STORES, TYPES = [(0, "online"), (1, "store_001")], [(1, "sale"), (3, "restock"), (4, "bopis")]


def dims(spark):
    return (
        spark.createDataFrame(STORES, "store_id int, name string"),
        spark.createDataFrame(TYPES, "change_type_id int, change_type string"),
    )


def some_time(rng):
    return at("00:00:00") + dt.timedelta(hours=rng.choice([0, 1, 5, 23, 24, 25, 48, 72, 90]))


def some_counts(rng, n):
    return [
        (rng.choice([1, 2, 3, None]), rng.choice([5, 6, None]), rng.choice([0, 1, None]),
         rng.choice([some_time(rng), some_time(rng), None]), rng.choice([1, 2, 2, None]))
        for _ in range(n)
    ]


def some_changes(rng, n):
    return [
        (f"t{k}", rng.choice([0, 1, 2, None]), rng.choice([some_time(rng)] * 5 + [None]),
         rng.choice([1, 3, 4, 9, None]), rng.choice([1, 2, 3, 4, None]), rng.choice([-2, 1, 7]))
        for k in range(n)
    ]


class Counts:
    """Counts that arrive file by file, and the stream that keeps the latest."""

    def __init__(self, spark, root, on_change=None):
        self.spark, self.landed, self.on_change = spark, str(root / "landed"), on_change
        self.checkpoint = str(root / "checkpoint")
        (root / "landed").mkdir()

    def run(self, data):
        df = self.spark.createDataFrame(data, schemas.SNAPSHOT)
        df.coalesce(1).write.mode("append").parquet(self.landed)
        stream = self.spark.readStream.schema(schemas.SNAPSHOT).parquet(self.landed)
        query = keep_latest(
            stream, SNAPSHOT_KEY, SEQUENCE, self.checkpoint, TIE_BREAK, on_change=self.on_change
        )
        query.awaitTermination()
        self.read = sum(p["numInputRows"] for p in query.recentProgress)
        return rows(read_latest(self.spark, self.checkpoint, schemas.SNAPSHOT, SNAPSHOT_KEY, SEQUENCE, TIE_BREAK))


def test_kept_latest_equals_the_latest_of_all_history(spark, tmp_path):
    rng, counts, sent = random.Random(2), Counts(spark, tmp_path), []
    for n in (20, 1, 30):
        data = some_counts(rng, n)
        sent += data
        got = counts.run(data)
        assert got == rows(latest_snapshot(spark.createDataFrame(sent, schemas.SNAPSHOT)))
        # A restart goes on from the state: only the new file is read.
        assert counts.read == n


def test_only_changed_keys_are_passed_on(spark, tmp_path):
    seen = {}

    def on_change(changed, batch_id):
        seen[batch_id] = rows(changed)

    counts = Counts(spark, tmp_path, on_change)
    first = [(1, 5, 0, at("05:00:00"), 50), (2, 5, 0, at("05:00:00"), 20)]
    counts.run(first)
    counts.run([(1, 5, 0, at("01:00:00"), 99), (3, 5, 1, None, 7)])
    # The older row changes nothing; its key is passed on as it is.
    assert seen == {0: sorted(first), 1: rows(spark.createDataFrame([first[0], (3, 5, 1, None, 7)], schemas.SNAPSHOT))}


def test_nothing_is_kept_before_the_first_batch(spark, tmp_path):
    layout = Layout(str(tmp_path / "silver"))
    assert read_latest_snapshots(spark, layout).collect() == []
    assert read_change_counts(spark, layout).collect() == []
    got = read_day_sums(spark, layout)
    assert got.collect() == [] and "moved_at" in got.columns


@pytest.mark.parametrize("seed", [1, 2])
def test_inventory_of_sums_equals_that_of_changes(spark, seed):
    rng = random.Random(seed)
    stores, types = dims(spark)
    changes = spark.createDataFrame(some_changes(rng, 300), schemas.CHANGE)
    latest = latest_snapshot(spark.createDataFrame(some_counts(rng, 40), schemas.SNAPSHOT))
    want = current_inventory(latest, effective_changes(changes, stores, types))
    got = current_inventory_of_sums(
        latest,
        effective_sums(day_sums(changes), stores, types),
        effective_changes(changes_of_counted_days(changes, latest), stores, types),
    )
    assert got.schema == want.schema
    assert rows(got) == rows(want)


def _stream(spark, layout, root, changes, counts):
    sent, landed = str(root / "sent"), str(root / "landed")
    documents = to_documents(assemble_transactions(spark.createDataFrame(changes, schemas.CHANGE)))
    to_envelope(documents).write.mode("append").parquet(sent)
    spark.createDataFrame(counts, schemas.SNAPSHOT).write.mode("append").parquet(landed)
    started = start_change_streams(read_change_stream(spark, "parquet", {"path": sent}), layout)
    started += start_snapshot_streams(spark.readStream.schema(schemas.SNAPSHOT).parquet(landed), layout)
    for query in started:
        query.awaitTermination()


def test_kept_numbers_and_sums_over_several_runs(spark, tmp_path):
    rng, layout = random.Random(7), Layout(str(tmp_path / "silver"))
    all_counts = []
    for run in range(3):
        changes = [(f"{run}{t}", *rest) for t, *rest in some_changes(rng, 60)]
        counts = some_counts(rng, 15)
        all_counts += counts
        _stream(spark, layout, tmp_path, changes, counts)
    kept = read_silver_changes(spark, layout).drop("event_date")
    latest = latest_snapshot(spark.createDataFrame(all_counts, schemas.SNAPSHOT))
    assert rows(read_latest_snapshots(spark, layout)) == rows(latest)
    assert rows(read_change_counts(spark, layout)) == rows(count_changes(kept))
    assert rows(read_day_sums(spark, layout)) == rows(day_sums(kept))
    # No folder holds the parts of a micro-batch.
    assert not [p for p in (tmp_path / "silver").rglob("batch=*")]

    stores, types = dims(spark)
    got = streamed_inventory(spark, layout, read_latest_snapshots(spark, layout), stores, types)
    assert rows(got) == rows(current_inventory(latest, effective_changes(kept, stores, types)))


def test_a_refresh_reads_no_history_of_counts_and_changes_of_counted_days_only(spark, tmp_path):
    layout = Layout(str(tmp_path / "silver"))
    day = lambda d, h: dt.datetime(2021, 1, d, h)
    changes = [(f"t{d}{h}", 1, day(d, h), 1, 1, -1) for d in range(1, 11) for h in (1, 20)]
    _stream(spark, layout, tmp_path, changes, [(1, 5, 1, day(2, 3), 9), (1, 5, 1, day(4, 3), 50)])
    stores, types = dims(spark)
    df = streamed_inventory(spark, layout, read_latest_snapshots(spark, layout), stores, types)
    assert rows(df) == [(1, 1, 50, -13, 37, day(10, 20))]
    plan = plan_of(df).split("== Initial Plan ==")[0]
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    # All files read are changes, and of one day; counts would have an employee.
    assert scans and all("employee_id" not in line for line in scans)
    assert all(re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ = 2021-01-04", line) for line in scans)

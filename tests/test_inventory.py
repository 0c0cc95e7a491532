import random
from collections import Counter

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shelfstream import (
    current_inventory,
    current_inventory_by_quantity,
    distinct_items,
    inventory_for_bi,
    newest_first,
    recent_changes,
    schemas,
)
from shelfstream.operators.fanout import repeat_rows

EFFECTIVE = "store_id int, item_id int, date_time timestamp, quantity int"
CHANGES = (
    "trans_id string, store_id int, date_time timestamp, change_type_id int, "
    "item_id int, quantity int"
)
TYPES = [(1, "sale"), (2, "shrink"), (3, "restock"), (4, "bopis"), (-1, "snapshot")]


def current(spark, latest, effective):
    return current_inventory(
        spark.createDataFrame(latest, schemas.SNAPSHOT),
        spark.createDataFrame(effective, EFFECTIVE),
    )


def test_changes_from_the_count_on_are_added(spark):
    noon = at("12:00:00")
    moved = [(0, 1, noon, -3), (0, 1, at("11:59:59"), -50), (0, 1, at("13:00:00"), 10),
             (1, 1, at("13:00:00"), 77)]
    got = current(spark, [(1, 5, 0, noon, 20)], moved)
    assert got.columns == ["store_id", "item_id", "snapshot_quantity", "change_quantity",
                           "current_inventory", "date_time"]
    assert rows(got) == [(0, 1, 20, 7, 27, at("13:00:00"))]


def test_no_change_since_the_count(spark):
    noon = at("12:00:00")
    assert rows(current(spark, [(1, 5, 0, noon, 20)], [])) == [(0, 1, 20, 0, 20, noon)]


def test_never_counted_has_no_row(spark):
    assert rows(current(spark, [], [(0, 1, at("12:00:00"), 3)])) == []


def _brute_force(latest, effective):
    out = []
    for item, _, store, when, quantity in latest:
        moved = [(t, q) for s, i, t, q in effective
                 if None not in (s, i, t, when) and (s, i) == (store, item) and t >= when]
        change = sum(q for _, q in moved if q is not None)
        times = [t for t in [when, *[t for t, _ in moved]] if t is not None]
        now = None if quantity is None else quantity + change
        out.append((store, item, quantity, change, now, max(times, default=None)))
    return out


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_random_frames(spark, conf, broadcast):
    """NULL keys, times and quantities, ties, and a key with half of the rows."""
    conf(autoBroadcastJoinThreshold=broadcast, adaptive__autoBroadcastJoinThreshold=broadcast)
    rng = random.Random(3)
    keys = [(s, i) for s in (0, 1, None) for i in (1, 2, 3, None)]
    hours = [None, *[at(f"{h:02}:00:00") for h in range(24)]]
    latest = [(i, 5, s, rng.choice(hours), rng.choice([None, 4, 9])) for s, i in keys[:-2]]
    effective = [
        (*(rng.choice(keys) if rng.random() < 0.5 else (0, 1)), rng.choice(hours),
         rng.choice([None, -2, 1, 6]))
        for _ in range(500)
    ]
    got = Counter(map(tuple, current(spark, latest, effective).collect()))
    assert got == Counter(_brute_force(latest, effective))


def test_order_for_presentation(spark):
    latest = [(1, 5, 0, at("12:00:00"), 20), (2, 5, 0, at("13:00:00"), 30)]
    got = newest_first(current(spark, latest, []))
    assert [r.item_id for r in got.collect()] == [2, 1]


def test_by_quantity(spark):
    latest = [(1, 5, 0, at("12:00:00"), 50), (2, 5, 0, at("13:00:00"), 30)]
    got = current_inventory_by_quantity(
        spark.createDataFrame(latest, schemas.SNAPSHOT), spark.createDataFrame([], EFFECTIVE)
    )
    assert got.columns == ["store_id", "item_id", "snapshot_quantity", "change_quantity",
                           "current_quantity", "date_time"]
    assert [r.current_quantity for r in got.collect()] == [30, 50]


def report(spark, latest, changes, **options):
    return inventory_for_bi(
        current(spark, latest, []),
        spark.createDataFrame(changes, CHANGES),
        spark.createDataFrame(TYPES, schemas.CHANGE_TYPE),
        **options,
    )


def test_report_repeats_a_row_per_change_of_its_item_in_any_store(spark):
    noon = at("12:00:00")
    latest = [(1, 5, 0, noon, 20), (1, 5, 1, noon, 30), (2, 5, 7, noon, 40)]
    changes = [("a", 0, noon, 1, 1, -1), ("b", 1, noon, 1, 1, -1), ("c", 5, noon, 9, 1, -1)]
    got = report(spark, latest, changes)
    assert got.columns == ["date", "store_id", "item_id", "change_type", "current_inventory",
                           "change_quantity", "snapshot_quantity", "date_time"]
    assert Counter((r.store_id, r.item_id, r.change_type) for r in got.collect()) == {
        ("Online_01", 1, "sale"): 2,
        ("Online_01", 1, None): 1,
        ("Store_01", 1, "sale"): 2,
        ("Store_01", 1, None): 1,
        ("Something_new", 2, None): 1,
    }
    assert {r.date for r in got.collect()} == {noon.date()}


def test_compact_report_unrolls_to_the_full_one(spark):
    rng = random.Random(5)
    noon = at("12:00:00")
    latest = [(i, 5, s, noon, 20) for i in (1, 2, 3, None) for s in (0, 1)]
    changes = [(str(n), rng.randrange(3), noon, rng.choice([1, 2, 3, 4, 9, None]),
                rng.choice([1, 1, 1, 2, 8, None]), -1) for n in range(200)]
    full = Counter(map(tuple, report(spark, latest, changes).collect()))
    compact = report(spark, latest, changes, compact=True)
    assert Counter({tuple(r)[:-1]: r.n for r in compact.collect()}) == full

    labels = dict(TYPES)
    plain = Counter()
    for item, _, _, _, _ in latest:
        types = [labels.get(c[3]) for c in changes if item is not None and c[4] == item]
        plain.update((item, t) for t in types or [None])
    assert Counter((r[2], r[3]) for r in full.elements()) == plain


def test_repeat_in_blocks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), ("d", 3)], "k string, n int")
    for block in (1, 2, 3, 100):
        got = repeat_rows(df, F.col("n"), ["k"], block)
        assert Counter(r.k for r in got.collect()) == {"a": 7, "c": 1, "d": 3}


def test_recent_changes_do_not_alter_the_result(spark):
    noon = at("12:00:00")
    latest = spark.createDataFrame(
        [(1, 5, 0, noon, 20), (2, 5, 0, at("2021-01-03 00:00:00"), 5)], schemas.SNAPSHOT
    )
    moved = [(0, i, at(f"2021-01-0{d} {h:02}:00:00"), 1)
             for i in (1, 2) for d in (1, 2, 3) for h in (6, 12, 18)]
    effective = spark.createDataFrame(moved, EFFECTIVE)
    recent = recent_changes(effective, latest)
    assert recent.count() == 16
    assert rows(current_inventory(latest, recent)) == rows(current_inventory(latest, effective))


def test_distinct_items(spark):
    items = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 1, 1), (None, "c", 1, 1)],
                                  schemas.ITEM)
    assert distinct_items(items).first()[0] == 1

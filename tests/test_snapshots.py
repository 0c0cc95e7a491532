import random

from conftest import at, rows

from shelfstream import latest_by_key, latest_snapshot, snapshot_at, snapshot_of_store, schemas


def counts(spark, data):
    return spark.createDataFrame(data, schemas.SNAPSHOT)


def test_newest_wins_whatever_the_order(spark):
    data = [(1, 5, 0, at("02:00:00"), 20), (1, 5, 0, at("01:00:00"), 99)]
    assert rows(latest_snapshot(counts(spark, data))) == [data[0]]


def test_ties_go_to_quantity_then_employee(spark):
    t = at("01:00:00")
    data = [(1, 5, 0, t, 20), (1, 6, 0, t, 20), (1, 9, 0, t, 3)]
    assert rows(latest_snapshot(counts(spark, data))) == [(1, 6, 0, t, 20)]


def test_undated_never_replaces_dated(spark):
    data = [(1, 5, 0, None, 99), (1, 5, 0, at("01:00:00"), 20), (2, 5, 0, None, 7)]
    assert rows(latest_snapshot(counts(spark, data))) == [(1, 5, 0, at("01:00:00"), 20),
                                                         (2, 5, 0, None, 7)]


def test_random_frames_with_null_keys(spark):
    rng = random.Random(7)
    data = [
        (rng.choice([1, 2, None]), rng.randrange(3), rng.choice([0, 0, 0, 1, None]),
         rng.choice([None, at("01:00:00"), at("02:00:00"), at("03:00:00")]), rng.randrange(4))
        for _ in range(300)
    ]
    best = {}
    for row in data:
        item, employee, store, when, quantity = row
        rank = (when is not None, when, quantity, employee)
        if (store, item) not in best or _over(rank, best[store, item][0]):
            best[store, item] = (rank, row)
    expected = [row for _, row in best.values()]
    assert rows(latest_snapshot(counts(spark, data))) == rows(counts(spark, expected))


def _over(a, b):
    key = lambda r: (r[0], r[1] or at("00:00:00"), *r[2:])
    return key(a) > key(b)


def test_other_keys_and_columns(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")],
                               "k string, n int, v string")
    assert rows(latest_by_key(df, ["k"], "n")) == [("a", 2, "y"), ("b", 1, "z")]


def test_lookups(spark):
    data = [(1, 5, 0, at("02:00:00"), 20), (1, 5, 1, at("01:00:00"), 99)]
    assert rows(snapshot_of_store(counts(spark, data), 1)) == [data[1]]
    assert rows(snapshot_at(counts(spark, data), 0, "2021-01-01 02:00:00")) == [data[0]]
    assert snapshot_at(counts(spark, data), 0, "2021-01-01 01:00:00").count() == 0

import json

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shelfstream import (
    changes_of,
    dedup_changes,
    effective_changes,
    flatten_events,
    malformed_changes,
    parse_events,
)
from shelfstream.operators.changes import CHANGE_COLUMNS

CHANGES = (
    "trans_id string, store_id int, date_time timestamp, change_type_id int, "
    "item_id int, quantity int"
)
DOCUMENT = {
    "date_time": "2021-01-01T00:00:15.000Z",
    "trans_id": "A",
    "store_id": 1,
    "change_type_id": 1,
    "items": [{"item_id": 1, "quantity": -1}, {"item_id": 2, "quantity": -3}],
}


def flat(spark, *payloads, **options):
    raw = spark.createDataFrame([(p.encode(),) for p in payloads], "value binary")
    return flatten_events(parse_events(raw), **options)


def test_one_row_per_item(spark):
    assert rows(flat(spark, json.dumps(DOCUMENT))) == [
        ("A", 1, at("00:00:15"), 1, 1, -1),
        ("A", 1, at("00:00:15"), 1, 2, -3),
    ]


def test_whole_event_can_be_kept(spark):
    df = flat(spark, json.dumps(DOCUMENT), keep_event=True)
    assert df.columns == ["event", *CHANGE_COLUMNS]
    assert [len(r.event["items"]) for r in df.collect()] == [2, 2]


def test_events_without_items_keep_one_row(spark):
    empty = json.dumps({**DOCUMENT, "items": []})
    missing = json.dumps({k: v for k, v in DOCUMENT.items() if k != "items"})
    assert rows(flat(spark, empty, missing)) == [("A", 1, at("00:00:15"), 1, None, None)] * 2


def test_single_quoted_text_is_read(spark):
    assert rows(flat(spark, str(DOCUMENT))) == rows(flat(spark, json.dumps(DOCUMENT)))


def test_bad_payloads_do_not_fail(spark):
    bad_date = json.dumps({**DOCUMENT, "date_time": "yesterday"})
    df = flat(spark, "garbage", "garbage", bad_date)
    undated = ("A", 1, None, 1)
    assert rows(dedup_changes(df)) == [
        (None,) * 6,
        (*undated, 1, -1),
        (*undated, 2, -3),
    ]
    assert malformed_changes(df).count() == 4


def test_resend_and_repeated_item_collapse(spark):
    resent = json.dumps(DOCUMENT)
    other = json.dumps({**DOCUMENT, "items": [{"item_id": 1, "quantity": -9}]})
    assert rows(dedup_changes(flat(spark, resent, resent, other))) == [
        ("A", 1, at("00:00:15"), 1, 1, -9),
        ("A", 1, at("00:00:15"), 1, 2, -3),
    ]


def test_dated_change_wins_over_undated(spark):
    changes = [("A", 1, None, 1, 1, -9), ("A", 1, at("02:00:00"), 1, 1, 5),
               ("A", 1, at("01:00:00"), 1, 1, 7)]
    df = spark.createDataFrame(changes, CHANGES)
    assert rows(dedup_changes(df)) == [("A", 1, at("01:00:00"), 1, 1, 7)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        dedup_changes(spark.createDataFrame([], CHANGES), mode="x")


def test_only_online_pickup_orders_are_dropped(spark):
    stores = spark.createDataFrame([(0, "online"), (1, "store_001"), (2, None)],
                                   "store_id int, name string")
    types = spark.createDataFrame([(1, "sale"), (4, "bopis")],
                                  "change_type_id int, change_type string")
    t = at("01:00:00")
    changes = [("a", 0, t, 4, 1, -1), ("b", 1, t, 4, 2, -1), ("c", 2, t, 4, 3, -1),
               ("d", 2, t, 1, 4, -1), ("e", 0, t, 1, 5, -1), ("f", 9, t, 1, 6, -1),
               ("g", 1, t, 9, 7, -1), ("h", None, t, 1, 8, -1)]
    got = effective_changes(spark.createDataFrame(changes, CHANGES), stores, types)
    assert got.columns == ["store_id", "item_id", "date_time", "quantity"]
    assert sorted(r.item_id for r in got.collect()) == [2, 4, 5]


def test_lookup_of_one_transaction(spark):
    t = at("01:00:00")
    df = spark.createDataFrame([("a", 0, t, 4, 1, -1), ("b", 1, t, 4, 2, -1)], CHANGES)
    assert changes_of(df, "b").select(F.col("item_id")).first()[0] == 2

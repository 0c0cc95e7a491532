import datetime as dt
import random
from collections import Counter

import pytest
from conftest import at, rows

from shelfstream import event_gaps, schemas, snapshot_release, snapshot_times

TXNS = "store_id int, date_time timestamp, trans_id string"
START = at("23:58:30")


def _times(rng, n):
    """Crowded moments, minutes apart, and days apart."""
    steps = [0, 0, 0.25, 1, 59, 61, 3600, 86400 * 3]
    return [START + dt.timedelta(seconds=rng.choice(steps) + rng.choice(steps)) for _ in range(n)]


@pytest.mark.parametrize("by_store", [False, True])
def test_gaps_of_random_transactions(spark, by_store):
    rng = random.Random(11)
    txns = [(rng.randrange(3), t, f"t{n}") for n, t in enumerate(_times(rng, 200))]
    want = []
    for group in [{s} for s in range(3)] if by_store else [{0, 1, 2}]:
        last = None
        for store, when, name in sorted((x for x in txns if x[0] in group), key=lambda x: x[1:]):
            gap = int((when - (last or when)).total_seconds())
            want.append((store, when, name, gap))
            last = when
    got = event_gaps(spark.createDataFrame(txns, TXNS), by_store=by_store)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_lines_of_one_transaction_count_once(spark):
    txns = [(0, START, "a")] * 3 + [(0, START + dt.timedelta(seconds=25), "b")] * 4
    got = event_gaps(spark.createDataFrame(txns, TXNS)).orderBy("trans_id").collect()
    assert [(r.trans_id, r.gap_seconds) for r in got] == [("a", 0), ("b", 25)]


def test_null_ids_and_times(spark):
    txns = [(0, START, None), (0, START, "b"), (0, START + dt.timedelta(hours=1), None),
            (0, START + dt.timedelta(hours=1), "a"), (0, None, "z")]
    got = event_gaps(spark.createDataFrame(txns, TXNS))
    assert {(r.date_time, r.trans_id): r.gap_seconds for r in got.collect()} == {
        (START, None): 0, (START, "b"): 0, (START + dt.timedelta(hours=1), None): 3600,
        (START + dt.timedelta(hours=1), "a"): 0, (None, "z"): 0,
    }


@pytest.mark.parametrize("by_store", [False, True])
def test_release_of_random_counts(spark, by_store):
    rng = random.Random(13)
    changes = [(rng.randrange(3), t) for t in _times(rng, 60)] + [(1, None)]
    counts = [(rng.randrange(4), t) for t in _times(rng, 80)]
    counts += [(0, START - dt.timedelta(days=9)), (0, START + dt.timedelta(days=99))]
    want = set()
    for store, when in counts:
        later = [t for s, t in changes if t and t >= when and (not by_store or s == store)]
        want.add((store, when, min(later, default=None)))
    got = snapshot_release(
        spark.createDataFrame([(1, 5, s, t, 2) for s, t in counts], schemas.SNAPSHOT),
        spark.createDataFrame(changes, "store_id int, date_time timestamp"),
        by_store,
    )
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_snapshot_times(spark):
    t1, t2 = at("01:00:00"), at("02:00:00")
    data = [(1, 5, 0, t2, 2), (2, 5, 0, t2, 2), (1, 5, 1, t1, 2)]
    got = snapshot_times(spark.createDataFrame(data, schemas.SNAPSHOT))
    assert [tuple(r) for r in got.collect()] == [(t1, 1), (t2, 0)]
    assert rows(got) == [(t1, 1), (t2, 0)]

import json
import time

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shelfstream import (
    current_inventory,
    dedup_changes,
    effective_changes,
    flatten_events,
    inventory_for_bi,
    latest_snapshot,
    parse_events,
    schemas,
)
from shelfstream.operators.changes import CHANGE_COLUMNS
from shelfstream.operators.snapshots import SEQUENCE, SNAPSHOT_KEY, TIE_BREAK
from shelfstream.plans import (
    DATASETS,
    Layout,
    gold_datasets,
    read_silver_changes,
    refresh_dimensions,
    refresh_gold,
    start_refreshes,
    start_streams,
)
from shelfstream.sinks import create_database, drop_database
from shelfstream.sources import read_change_stream, read_dataset_stream, read_snapshot_stream
from shelfstream.streaming import (
    append_stream,
    change_stream,
    merge_statement,
    refresh_with,
)


def document(trans_id, hour, *items, store=1, kind=1, minute=0):
    return json.dumps({
        "date_time": f"2021-01-01T{hour:02}:{minute:02}:00.000Z", "trans_id": trans_id,
        "store_id": store, "change_type_id": kind,
        "items": [{"item_id": i, "quantity": q} for i, q in items],
    })


def send(spark, path, *payloads):
    """One file of messages, and so one micro-batch where files are read one by one."""
    envelope = schemas.struct_type(schemas.ENVELOPE)
    data = [(None, p.encode(), "t", 0, n, None, 0, None) for n, p in enumerate(payloads)]
    df = spark.createDataFrame(data, envelope).coalesce(1)
    df.write.mode("append").parquet(str(path))
    time.sleep(0.02)


class Changes:
    """A change stream over files, and the rows that have come out of it."""

    def __init__(self, spark, root, mode="exact"):
        self.spark, self.raw, self.mode = spark, root / "raw", mode
        self.out, self.checkpoint = str(root / "out"), str(root / "checkpoint")
        self.raw.mkdir()
        self.state = []

    def run(self, *batches):
        for payloads in batches:
            send(self.spark, self.raw, *payloads)
        options = {"path": str(self.raw), "maxFilesPerTrigger": "1"}
        stream = change_stream(
            read_change_stream(self.spark, "parquet", options), mode=self.mode
        )
        query = append_stream(stream, self.out, self.checkpoint)
        query.awaitTermination()
        self.state += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
        self.inputs = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        return rows(self.spark.read.parquet(self.out).select(*CHANGE_COLUMNS))


def test_stream_equals_batch(spark, tmp_path):
    changes = Changes(spark, tmp_path)
    batches = [
        [document("A", 1, (1, -1), (2, -2)), document("B", 1, (1, -4))],
        [document("C", 2, (1, -1)), document("B", 1, (1, -4), minute=0)],
        [document("D", 3, (5, 9))],
    ]
    got = changes.run(*batches)
    raw = spark.read.parquet(str(changes.raw))
    assert got == rows(dedup_changes(flatten_events(parse_events(raw))))
    # One file, and no more, per micro-batch.
    assert changes.inputs == [2, 2, 1]


def test_late_changes_are_dropped(spark, tmp_path):
    batches = [
        [document("A", 9, (1, -1))], [document("B", 9, (1, -1))], [document("LATE", 2, (1, -1))]
    ]
    got = {}
    for mode in ("exact", "watermark", "bounded"):
        (tmp_path / mode).mkdir()
        got[mode] = [r[0] for r in Changes(spark, tmp_path / mode, mode).run(*batches)]
    assert got == {"exact": ["A", "B", "LATE"], "watermark": ["A", "B"], "bounded": ["A", "B"]}


def test_a_resend_hours_later_is_dropped_and_undated_changes_kept_once(spark, tmp_path):
    changes = Changes(spark, tmp_path)
    got = changes.run(
        [document("A", 1, (1, -1)), "garbage"],
        [document("B", 9, (1, -1))],
        [document("A", 10, (1, -1)), "garbage", document("B", 9, (1, -1))],
    )
    raw = spark.read.parquet(str(changes.raw))
    assert got == rows(dedup_changes(flatten_events(parse_events(raw))))
    assert [r[0] for r in got] == [None, "A", "B"]
    # One entry per key, whatever is sent again.
    assert changes.state[-1] == 3


def test_restart_from_checkpoint_remembers_keys(spark, tmp_path):
    changes = Changes(spark, tmp_path)
    changes.run([document("A", 1, (1, -1))])
    got = changes.run([document("A", 1, (1, -1)), document("B", 1, (1, -1))])
    assert [r[0] for r in got] == ["A", "B"]


def test_state_is_let_go_in_bounded_form_only(spark, tmp_path):
    batches = [[document(f"T{h}", h, (1, -1))] for h in range(0, 10, 2)]
    sizes = {}
    for mode in ("bounded", "watermark", "exact"):
        (tmp_path / mode).mkdir()
        changes = Changes(spark, tmp_path / mode, mode)
        assert len(changes.run(*batches)) == 5
        sizes[mode] = changes.state[-1]
    assert sizes == {"bounded": 1, "watermark": 5, "exact": 5}


def test_undated_changes_by_mode(spark, tmp_path):
    batches = [["garbage", "garbage", document("A", 1, (1, -1))], ["garbage"]]
    got = {}
    for mode in ("bounded", "watermark", "exact"):
        (tmp_path / mode).mkdir()
        got[mode] = Changes(spark, tmp_path / mode, mode).run(*batches)
    dated = ("A", 1, at("01:00:00"), 1, 1, -1)
    both = [(None,) * 6, dated]
    assert got == {"bounded": [dated], "watermark": both, "exact": both}


def land(spark, path, data):
    df = spark.createDataFrame(data, schemas.SNAPSHOT).coalesce(1)
    df.select(F.lit(0).alias("id"), "*").write.mode("append").option("header", True).csv(
        str(path)
    )
    time.sleep(0.02)


def test_latest_counts_from_a_stream(spark, tmp_path):
    landed, history = tmp_path / "landed", tmp_path / "history"
    landed.mkdir()

    def run():
        stream = read_snapshot_stream(spark, str(landed), max_files_per_trigger=1)
        query = append_stream(stream, str(history), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        kept = spark.read.schema(schemas.SNAPSHOT).parquet(str(history))
        return len([p for p in query.recentProgress if p["numInputRows"]]), rows(latest_snapshot(kept))

    newer = [(1, 5, 0, at("05:00:00"), 50), (2, 5, 0, at("05:00:00"), 20)]
    older = [(1, 5, 0, at("01:00:00"), 99), (3, 5, 1, at("01:00:00"), 7)]
    tie = [(2, 9, 0, at("05:00:00"), 20)]
    land(spark, landed, newer)
    land(spark, landed, older)
    # Files that are already there are read, one per micro-batch.
    assert run() == (2, sorted([newer[0], newer[1], older[1]]))
    land(spark, landed, tie)
    assert run() == (1, sorted([newer[0], tie[0], older[1]]))


def test_merge_beats_by_the_same_order(spark):
    """The statement parses, and its condition orders rows as the batch operator does."""
    order = [SEQUENCE, *TIE_BREAK]
    text = merge_statement("kept", "batch", SNAPSHOT_KEY, order)
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    beats = text.split("WHEN MATCHED AND ")[1].split(" THEN ")[0]
    some = [(1, e, 0, t, q) for e in (5, None) for t in (at("01:00:00"), at("02:00:00"), None)
            for q in (1, 2, None)]
    df = spark.createDataFrame(some, schemas.SNAPSHOT)
    pairs = df.alias("t").join(df.alias("s"), F.expr("true"), "inner").select(
        F.expr(beats).alias("beats"), F.struct("t.*").alias("t"), F.struct("s.*").alias("s")
    )
    rank = lambda r: [(r[c] is not None, r[c] or 0) if c != SEQUENCE else
                      (r[c] is not None, r[c] or at("00:00:00")) for c in order]
    assert all(bool(r.beats) == (rank(r.s) > rank(r.t)) for r in pairs.collect())


@pytest.fixture
def database(spark):
    create_database(spark, "shelf_stream")
    yield "shelf_stream"
    drop_database(spark, "shelf_stream")


def test_whole_flow_with_recomputed_gold(spark, tmp_path, database):
    raw, landed = tmp_path / "raw", tmp_path / "landed"
    raw.mkdir(), landed.mkdir()
    (tmp_path / "store").write_text("store_id,name\n0,online\n1,store_001\n")
    (tmp_path / "type").write_text("change_type_id,change_type\n1,sale\n3,restock\n4,bopis\n")
    (tmp_path / "item").write_text("item_id,name,supplier_id,safety_stock_quantity\n1,nut,1,2\n")
    dims = [str(tmp_path / n) for n in ("store", "item", "type")]
    refresh_dimensions(spark, database, *dims)
    assert spark.table(f"{database}.item").count() == 1
    layout = Layout(str(tmp_path / "silver"))

    def step():
        options = {"path": str(raw)}
        started = start_streams(
            read_change_stream(spark, "parquet", options),
            read_snapshot_stream(spark, str(landed)),
            layout,
            keep_event=True,
            write_tasks=1,
        )
        for query in started:
            query.awaitTermination()
        refresh_gold(spark, database, layout)
        return rows(spark.table(f"{database}.inventory_current"))

    land(spark, landed, [(1, 5, 1, at("02:00:00"), 20), (1, 5, 0, at("02:00:00"), 5)])
    send(spark, raw, document("A", 1, (1, -9)), document("B", 2, (1, -3)),
         document("C", 3, (1, -2), store=0, kind=4), "garbage")
    assert step() == [
        (0, 1, 5, 0, 5, at("02:00:00")),
        (1, 1, 20, -3, 17, at("02:00:00")),
    ]
    # A later count replaces what an earlier one led to.
    land(spark, landed, [(1, 5, 1, at("04:00:00"), 30)])
    send(spark, raw, document("D", 5, (1, -1)), document("B", 2, (1, -3)))
    second = step()
    assert second == [
        (0, 1, 5, 0, 5, at("02:00:00")),
        (1, 1, 30, -1, 29, at("05:00:00")),
    ]
    assert spark.table(f"{database}.inventory_current_transformed").count() == 8
    assert spark.read.parquet(layout.snapshots).count() == 3
    assert spark.read.parquet(layout.raw).count() == 6
    kept = spark.read.parquet(layout.changes)
    assert kept.filter("event.trans_id = trans_id").count() == 4
    assert kept.count() == 5 and kept.filter("event_date IS NULL").count() == 1
    one_file_per_day_and_run = list((tmp_path / "silver/inventory_change").rglob("*.parquet"))
    assert len(one_file_per_day_and_run) == 3

    # Every dataset can be read by its name, with what later runs have added.
    sizes = {name: spark.table(f"{database}.{name}").count() for name in DATASETS}
    assert sizes == {
        "store": 2, "item": 1, "inventory_change_type": 3, "raw_inventory_change": 6,
        "inventory_change": 5, "inventory_snapshot": 3, "latest_inventory_snapshot": 2,
        "inventory_current": 2, "inventory_current_transformed": 8,
    }
    sale = spark.sql(f"SELECT quantity FROM {database}.inventory_change WHERE trans_id = 'D'")
    assert rows(sale) == [(-1,)]
    for name, (_, quality) in DATASETS.items():
        found = spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect()
        assert ("quality", quality) in [(r.key, r.value) for r in found]

    refresh_gold(spark, database, layout, compact=True)
    compact = spark.table(f"{database}.inventory_current_transformed")
    assert compact.select(F.sum("n")).first()[0] == 8

    # The report is the one the whole history gives.
    changes = read_silver_changes(spark, layout)
    current, types = (
        spark.table(f"{database}.{n}") for n in ("inventory_current", "inventory_change_type")
    )
    assert rows(compact) == rows(inventory_for_bi(current, changes, types, compact=True))
    stores, types = (spark.table(f"{database}.{n}") for n in ("store", "inventory_change_type"))
    latest = spark.table(f"{database}.latest_inventory_snapshot")
    gold = gold_datasets(changes, latest, stores, types)["inventory_current"]
    plain = current_inventory(latest, effective_changes(changes, stores, types))
    assert rows(gold) == rows(plain) == second


def test_tables_are_refreshed_by_the_clock(spark, tmp_path, database):
    (tmp_path / "store").write_text("store_id,name\n1,store_001\n")
    (tmp_path / "type").write_text("change_type_id,change_type\n1,sale\n")
    (tmp_path / "item").write_text("item_id,name,supplier_id,safety_stock_quantity\n1,nut,1,2\n")
    dims = [str(tmp_path / n) for n in ("store", "item", "type")]
    layout = Layout(str(tmp_path / "silver"))
    (tmp_path / "landed").mkdir(), (tmp_path / "raw").mkdir()
    land(spark, tmp_path / "landed", [(1, 5, 1, at("02:00:00"), 20)])
    send(spark, tmp_path / "raw", document("A", 3, (1, -9)))
    started = start_streams(
        read_change_stream(spark, "parquet", {"path": str(tmp_path / "raw")}),
        read_snapshot_stream(spark, str(tmp_path / "landed")),
        layout,
    )
    for query in started:
        query.awaitTermination()
    running = start_refreshes(spark, database, layout, *dims, gold_interval="1 second")
    name = f"{database}.inventory_current_transformed"
    try:
        deadline = time.time() + 60
        while not spark.catalog.tableExists(name) and time.time() < deadline:
            time.sleep(0.5)
        assert all(query.isActive for query in running)
    finally:
        for query in running:
            query.stop()
    assert rows(spark.table(f"{database}.inventory_current")) == [
        (1, 1, 20, -9, 11, at("03:00:00"))
    ]


def test_gold_is_refreshed_before_any_message(spark, tmp_path, database):
    for name, rows_of in (("store", [(1, "store_001")]), ("inventory_change_type", [(1, "sale")])):
        key = "store_id" if name == "store" else "change_type_id"
        label = "name" if name == "store" else "change_type"
        df = spark.createDataFrame(rows_of, f"{key} int, {label} string")
        df.write.saveAsTable(f"{database}.{name}")
    refresh_gold(spark, database, Layout(str(tmp_path / "silver")), location=str(tmp_path / "t"))
    for name in ("inventory_current", "inventory_current_transformed"):
        assert spark.table(f"{database}.{name}").count() == 0


def test_refresh_follows_a_stream_of_a_table(spark, tmp_path, database):
    name = f"{database}.ticks"
    spark.range(3).write.saveAsTable(name)
    calls = []
    query = refresh_with(
        read_dataset_stream(spark, name), lambda: calls.append(1), str(tmp_path / "c"), None
    )
    query.awaitTermination()
    assert calls == [1]


def test_interval_keeps_a_stream_running(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    land(spark, landed, [(1, 5, 0, at("05:00:00"), 50)])
    query = append_stream(
        read_snapshot_stream(spark, str(landed)), str(tmp_path / "out"),
        str(tmp_path / "checkpoint"), "1 minute",
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    finally:
        query.stop()

"""Operators applied to whole tables of the driver.

Each query takes a session and a folder of tables. Times come back without a zone, lists
as text, so that results compare by value.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream import fixtures, functions, schemas, session
from shelfstream.operators import changes as ch
from shelfstream.operators import distinct as di
from shelfstream.operators import inventory as inv
from shelfstream.operators import snapshots as sn
from shelfstream.operators import timeline as tm
from shelfstream.operators import transactions as tx
from shelfstream.plans.retail import (
    Layout,
    read_latest_snapshots,
    read_silver_changes,
    refresh_gold,
    start_change_streams,
    start_raw_stream,
    start_snapshot_streams,
    start_streams,
)
from shelfstream.sinks import (
    create_database,
    drop_database,
    publish,
    save_dataset,
    to_envelope,
    use_database,
    write_snapshot_files,
)
from shelfstream.sources import (
    read_change_stream,
    read_change_type,
    read_changes,
    read_dataset,
    read_dataset_stream,
    read_item,
    read_landed_snapshots,
    read_snapshot_stream,
    read_snapshots,
    read_store,
)
from shelfstream.storage import child_names, work_dir
from shelfstream.streaming import (
    account_of,
    accounted_changes,
    append_stream,
    change_stream,
    refresh_with,
)
from shelfstream.streaming.changes import triggered

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Stream times keep their microseconds on the wire.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# A small message limit, so that ordinary transactions are split.
SPLIT_OCTETS = 250
FIRST_N = 100
LOOKUP_TRANS_ID = "1"
LOOKUP_STORE_ID = 1


def _query(build: Query) -> Query:
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.configure(spark)
        df = build(spark, sf_dir)
        zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[build.__name__] = run
    return run


# -- inputs -------------------------------------------------------------------


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sn.latest_snapshot(fixtures.snapshots(spark, sf_dir))


def _effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.effective_changes(
        fixtures.changes(spark, sf_dir), fixtures.stores(spark), fixtures.change_types(spark)
    )


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.current_inventory(_latest(spark, sf_dir), _effective(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.strip_braces(fixtures.lines(spark, sf_dir))


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.assemble_transactions(_lines(spark, sf_dir))


def _items_text(items: Column | str) -> Column:
    entry = lambda item: F.concat_ws(":", item["item_id"], item["quantity"])
    return F.array_join(F.transform(items, entry), ",")


# -- composed datasets --------------------------------------------------------


@_query
def inventory_current(spark, sf_dir):
    return _current(spark, sf_dir)


@_query
def inventory_current_by_quantity(spark, sf_dir):
    return inv.current_inventory_by_quantity(_latest(spark, sf_dir), _effective(spark, sf_dir))


@_query
def inventory_bi(spark, sf_dir):
    return inv.inventory_for_bi(
        _current(spark, sf_dir), fixtures.changes(spark, sf_dir), fixtures.change_types(spark)
    )


@_query
def inventory_bi_compact(spark, sf_dir):
    return inv.inventory_for_bi(
        _current(spark, sf_dir),
        fixtures.changes(spark, sf_dir),
        fixtures.change_types(spark),
        compact=True,
    )


@_query
def change_effective(spark, sf_dir):
    return _effective(spark, sf_dir)


@_query
def latest_snapshot(spark, sf_dir):
    return _latest(spark, sf_dir)


@_query
def latest_of_store(spark, sf_dir):
    return sn.snapshot_of_store(_latest(spark, sf_dir), LOOKUP_STORE_ID)


# -- transactions -------------------------------------------------------------


@_query
def txn_assemble(spark, sf_dir):
    return _transactions(spark, sf_dir).select(
        *tx.HEADER, F.size("items").alias("n_items"), _items_text("items").alias("items")
    )


@_query
def txn_json_roundtrip(spark, sf_dir):
    messages = to_envelope(tx.to_documents(_transactions(spark, sf_dir)))
    event = F.col("event")
    return ch.parse_events(messages).select(
        *[event[c].alias(c) for c in tx.HEADER],
        F.size(event["items"]).alias("n_items"),
        _items_text(event["items"]).alias("items"),
    )


@_query
def txn_split(spark, sf_dir):
    return tx.to_documents(tx.split_lines(_lines(spark, sf_dir), SPLIT_OCTETS))


@_query
def txn_split_micros(spark, sf_dir):
    cut = tx.split_documents(_transactions(spark, sf_dir), SPLIT_OCTETS, _MICROS)
    return tx.to_documents(cut, _MICROS)


@_query
def first_n_txns(spark, sf_dir):
    return tx.assemble_first_transactions(_lines(spark, sf_dir), FIRST_N).select(
        *tx.HEADER, _items_text("items").alias("items")
    )


# -- changes ------------------------------------------------------------------


@_query
def change_flatten(spark, sf_dir):
    messages = to_envelope(tx.to_documents(_transactions(spark, sf_dir)))
    flat = ch.flatten_events(ch.parse_events(messages), keep_event=True)
    return flat.select(*ch.CHANGE_COLUMNS, F.size("event.items").alias("event_items"))


@_query
def change_dedup(spark, sf_dir):
    return ch.dedup_changes(_lines(spark, sf_dir).select(*ch.CHANGE_COLUMNS))


@_query
def change_lookup(spark, sf_dir):
    changes = _lines(spark, sf_dir).select(*ch.CHANGE_COLUMNS)
    return ch.changes_of(changes, LOOKUP_TRANS_ID)


# -- order in time ------------------------------------------------------------


@_query
def snapshot_times(spark, sf_dir):
    return tm.snapshot_times(fixtures.snapshots(spark, sf_dir))


@_query
def snapshot_release(spark, sf_dir):
    return tm.snapshot_release(
        fixtures.snapshots(spark, sf_dir), fixtures.changes(spark, sf_dir)
    )


@_query
def snapshot_release_by_store(spark, sf_dir):
    return tm.snapshot_release(
        fixtures.snapshots(spark, sf_dir), fixtures.changes(spark, sf_dir), by_store=True
    )


@_query
def event_gap(spark, sf_dir):
    return tm.event_gaps(fixtures.changes(spark, sf_dir))


@_query
def event_gap_by_store(spark, sf_dir):
    return tm.event_gaps(fixtures.changes(spark, sf_dir), by_store=True)


# -- scalar functions ---------------------------------------------------------


@_query
def item_count_distinct(spark, sf_dir):
    return inv.distinct_items(fixtures.items(spark, sf_dir))


@_query
def item_count_by_span(spark, sf_dir):
    # Sketched in two parts, which share a day or more, and merged; next to the exact counts.
    changes, path = fixtures.changes(spark, sf_dir), work_dir(spark, "sketches")
    for some in _halves(changes):
        di.item_sketches(some).write.mode("append").parquet(path)
    sketches, off = spark.read.parquet(path), di.sketch_error()
    spans = []
    for unit in ("day", "month", "year"):
        about = di.distinct_items_of_sketches(sketches, unit).withColumnRenamed("items", "about")
        both = di.distinct_items_by(changes, unit).join(about, "start", "full")
        near = F.abs(F.col("about") - F.col("items")) <= F.col("items") * off
        spans.append(both.select(F.lit(unit).alias("span"), "start", "items", near.alias("estimate_near")))
    return functools.reduce(DataFrame.unionByName, spans)


@_query
def fn_trim_braces(spark, sf_dir):
    return fixtures.lines(spark, sf_dir).select(
        F.col("trans_id").alias("raw_id"), functions.strip_braces("trans_id").alias("trans_id")
    )


@_query
def fn_from_json(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return fixtures.table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@_query
def fn_date_format(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", functions.as_second_text(F.col("ts").cast("timestamp")).alias("text")
    )


@_query
def fn_to_date(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", F.to_date(F.col("ts").cast("timestamp")).alias("date")
    )


@_query
def fn_store_label(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "supplier").select(
        "s_suppkey", functions.store_label("s_nationkey").alias("store_id")
    )


@_query
def fn_document_time(spark, sf_dir):
    text = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSX")
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", functions.as_document_time(text).alias("date_time")
    )


@_query
def fn_timestamp(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", text.cast("timestamp").alias("date_time")
    )


# -- files and tables ---------------------------------------------------------


def _files(df: DataFrame, label: str) -> list[str]:
    """``df`` as CSV files with a header line, one folder per store; their paths."""
    root = work_dir(df.sparkSession, label)
    written = df.withColumn("folder", F.col("store_id"))
    written.write.partitionBy("folder").option("header", True).csv(root)
    names = child_names(df.sparkSession, root)
    return [f"{root}/{name}" for name in names if name.startswith("folder=")]


@_query
def src_change_files(spark, sf_dir):
    lines = fixtures.lines(spark, sf_dir).select(
        "trans_id", "item_id", "store_id",
        functions.as_second_text("date_time").alias("date_time"),
        "quantity", "change_type_id",
    )
    return read_changes(spark, _files(lines, "change-files"))


@_query
def src_snapshot_files(spark, sf_dir):
    counts = fixtures.snapshots(spark, sf_dir).withColumn(
        "date_time", functions.as_second_text("date_time")
    )
    return read_snapshots(spark, _files(counts, "count-files"))


@_query
def src_store_file(spark, sf_dir):
    path = work_dir(spark, "store-file")
    suppliers = fixtures.table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS store_id", "s_name AS name"
    )
    suppliers.write.option("header", True).csv(path)
    return read_store(spark, path)


@_query
def src_change_type_file(spark, sf_dir):
    path = work_dir(spark, "type-file")
    nations = fixtures.table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey AS int) AS change_type_id", "n_name AS change_type"
    )
    nations.write.option("header", True).csv(path)
    return read_change_type(spark, path)


@_query
def src_item_file(spark, sf_dir):
    path = work_dir(spark, "item-file")
    fixtures.items(spark, sf_dir).write.option("header", True).csv(path)
    return read_item(spark, path)


def _cut_times(df: DataFrame, unit: str) -> DataFrame:
    return df.withColumn("date_time", F.date_trunc(unit, "date_time"))


@_query
def snk_snapshot_files(spark, sf_dir):
    path = work_dir(spark, "landed-counts")
    write_snapshot_files(_cut_times(fixtures.snapshots(spark, sf_dir), "second"), path)
    return read_landed_snapshots(spark, path)


@_query
def snk_snapshot_files_twice(spark, sf_dir):
    path = work_dir(spark, "landed-counts")
    counts = _cut_times(fixtures.snapshots(spark, sf_dir), "day")
    write_snapshot_files(counts, path)
    write_snapshot_files(sn.snapshot_of_store(counts, LOOKUP_STORE_ID), path)
    return read_landed_snapshots(spark, path)


@_query
def snapshot_of_moment(spark, sf_dir):
    path = work_dir(spark, "landed-counts")
    counts = _cut_times(fixtures.snapshots(spark, sf_dir), "day")
    write_snapshot_files(counts, path)
    of_store = sn.snapshot_of_store(counts, LOOKUP_STORE_ID)
    first = of_store.agg(functions.as_second_text(F.min("date_time"))).first()[0]
    return read_landed_snapshots(spark, path, LOOKUP_STORE_ID, first)


def _database(spark: SparkSession) -> tuple[str, str]:
    """A new database, and the folder of its tables."""
    root = work_dir(spark, "tables")
    name = f"shelfstream_check_{root[-32:]}"
    create_database(spark, name, f"{root}/database")
    return name, root


@_query
def snk_inventory_table(spark, sf_dir):
    database, root = _database(spark)
    name = f"{database}.inventory_current"
    save_dataset(
        _current(spark, sf_dir), name, "current inventory", {"quality": "gold"}, root
    )
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    assert ("quality", "gold") in [(r.key, r.value) for r in found]
    return read_dataset(spark, name)


@_query
def snk_table_refresh(spark, sf_dir):
    database, root = _database(spark)
    name = f"{database}.effective"
    for rows in (_effective(spark, sf_dir).filter("store_id = 0"), _effective(spark, sf_dir)):
        save_dataset(rows, name, "effective changes", {"quality": "gold"}, root)
    return read_dataset(spark, name)


@_query
def snk_database(spark, sf_dir):
    database, root = _database(spark)
    before = spark.catalog.currentDatabase()
    use_database(spark, database)
    fixtures.items(spark, sf_dir).write.option("path", f"{root}/item").saveAsTable("item")
    use_database(spark, before)
    copy = work_dir(spark, "items")
    read_dataset(spark, f"{database}.item").write.parquet(copy)
    drop_database(spark, database)
    assert not spark.catalog.databaseExists(database)
    return spark.read.parquet(copy)


def _row_text(df: DataFrame) -> Column:
    """All columns of a row as one text, times to the microsecond."""
    texts = []
    for name, kind in df.dtypes:
        text = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind == "timestamp" else F.col(name)
        texts.append(F.coalesce(text.cast("string"), F.lit("-")))
    return F.concat_ws("|", *texts)


@_query
def src_inspect_tables(spark, sf_dir):
    database, root = _database(spark)
    current = _current(spark, sf_dir)
    stores = fixtures.table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS store_id", "s_name AS name"
    )
    kinds = fixtures.table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey AS int) AS change_type_id", "n_name AS change_type"
    )
    tables = {
        "item": fixtures.items(spark, sf_dir),
        "inventory_change": fixtures.changes(spark, sf_dir).select(*ch.CHANGE_COLUMNS),
        "inventory_snapshot": fixtures.snapshots(spark, sf_dir),
        "latest_inventory_snapshot": _latest(spark, sf_dir),
        "inventory_current": current,
        "store": stores,
        "inventory_change_type": kinds,
    }
    found = []
    for name, rows in tables.items():
        save_dataset(rows, f"{database}.{name}", name, {}, f"{root}/{name}")
        stored = read_dataset(spark, f"{database}.{name}").select(*rows.columns)
        found.append(stored.select(F.lit(name).alias("dataset"), _row_text(stored).alias("row")))
    return functools.reduce(DataFrame.unionByName, found)


@_query
def src_table_stream(spark, sf_dir):
    database, root = _database(spark)
    fixtures.changes(spark, sf_dir).write.option("path", f"{root}/c").saveAsTable(f"{database}.c")
    stream = read_dataset_stream(spark, f"{database}.c")
    append_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@_query
def inventory_newest_first(spark, sf_dir):
    return inv.numbered_newest_first(_current(spark, sf_dir))


@_query
def snk_publish_text(spark, sf_dir):
    path = work_dir(spark, "published")
    publish(tx.to_documents(_transactions(spark, sf_dir)), "text", {"path": path})
    return ch.flatten_events(ch.parse_events(spark.read.text(path)))


# -- streams ------------------------------------------------------------------


def _halves(df: DataFrame) -> list[DataFrame]:
    """The earlier part of ``df`` by event time, undated rows with it, and the later part."""
    span = df.agg(F.min("date_time").alias("lo"), F.max("date_time").alias("hi")).select(
        F.timestamp_seconds((F.unix_seconds("lo") + F.unix_seconds("hi")) / 2).alias("cut")
    )
    cut = F.lit(span.first()["cut"])
    earlier = F.col("date_time").isNull() | (F.col("date_time") < cut)
    return [df.filter(earlier), df.filter(F.col("date_time") >= cut)]


def _send(documents: DataFrame, path: str) -> None:
    to_envelope(documents).write.mode("append").parquet(path)


def _land(snapshots: DataFrame, path: str) -> None:
    landed = snapshots.select(F.lit(0).alias("id"), "item_id", "employee_id", "store_id",
                              "date_time", "quantity")
    landed.write.mode("append").option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)


@_query
def stream_change_dedup(spark, sf_dir):
    root = work_dir(spark, "change-stream")
    raw, out, checkpoint = f"{root}/raw", f"{root}/changes", f"{root}/checkpoint"
    tx.to_documents(_transactions(spark, sf_dir)).write.parquet(f"{root}/documents")
    for documents in _halves(spark.read.parquet(f"{root}/documents")):
        # Sales are sent twice.
        _send(documents.unionByName(documents.filter("change_type_id = 1")), raw)
        stream = change_stream(read_change_stream(spark, "parquet", {"path": raw}))
        append_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(*ch.CHANGE_COLUMNS)


@_query
def stream_late_changes(spark, sf_dir):
    root = work_dir(spark, "late-changes")
    raw, out, checkpoint = f"{root}/raw", f"{root}/changes", f"{root}/checkpoint"
    # The earlier part is sent last, hours behind the watermark.
    for changes in reversed(_halves(fixtures.changes(spark, sf_dir))):
        _send(tx.to_documents(tx.assemble_transactions(changes), _MICROS), raw)
        messages = read_change_stream(spark, "parquet", {"path": raw})
        stream = change_stream(messages, mode="watermark")
        append_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(*ch.CHANGE_COLUMNS)


@_query
def stream_change_account(spark, sf_dir):
    root = work_dir(spark, "change-account")
    raw, out, checkpoint = f"{root}/raw", f"{root}/changes", f"{root}/checkpoint"
    found = None
    # The later part first. Sales are sent twice, and a broken copy of each error.
    for changes in reversed(_halves(_with_undated(fixtures.changes(spark, sf_dir)))):
        documents = tx.to_documents(tx.assemble_transactions(changes), _MICROS)
        broken = documents.filter("change_type_id = 2").withColumn("document", F.concat(F.lit("?"), "document"))
        _send(documents.unionByName(documents.filter("change_type_id = 1")).unionByName(broken), raw)
        query = append_stream(
            accounted_changes(read_change_stream(spark, "parquet", {"path": raw})), out, checkpoint
        )
        query.awaitTermination()
        account = account_of(query.recentProgress)
        found = account if found is None else found + account
    assert spark.read.parquet(out).count() == found.kept
    numbers = dataclasses.asdict(found)
    return spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{n} bigint" for n in numbers))


def _with_undated(changes: DataFrame) -> DataFrame:
    """Every seventh change has no time."""
    undated = F.col("trans_id").cast("bigint") % 7 == 0
    return changes.withColumn("date_time", F.when(~undated, F.col("date_time")))


def _resent(changes: DataFrame) -> DataFrame:
    """Every third change once more, hours later."""
    again = changes.filter(F.col("trans_id").cast("bigint") % 3 == 0)
    return again.withColumn("date_time", F.expr("date_time + INTERVAL 9 HOURS"))


@_query
def stream_change_resend(spark, sf_dir):
    layout = Layout(f"{work_dir(spark, 'resent-changes')}/silver")
    sent = f"{layout.root}/sent"
    changes = _with_undated(fixtures.changes(spark, sf_dir))
    for some in (changes, _resent(changes)):
        _send(tx.to_documents(tx.assemble_transactions(some), _MICROS), sent)
        stream = read_change_stream(spark, "parquet", {"path": sent})
        for query in start_change_streams(stream, layout):
            query.awaitTermination()
    return read_silver_changes(spark, layout).drop("event_date")


@_query
def stream_latest_snapshot(spark, sf_dir):
    root = work_dir(spark, "count-stream")
    layout, landed = Layout(f"{root}/silver"), f"{root}/landed"
    # Newer counts arrive before older ones.
    for counts in reversed(_halves(fixtures.snapshots(spark, sf_dir))):
        _land(counts, landed)
        for query in start_snapshot_streams(read_snapshot_stream(spark, landed), layout):
            query.awaitTermination()
    return read_latest_snapshots(spark, layout)


def _run_streams(spark: SparkSession, sf_dir: str) -> Layout:
    """All streams over changes and counts, in two runs on one checkpoint, with resends."""
    root = work_dir(spark, "retail")
    layout = Layout(f"{root}/silver")
    sent, landed = f"{root}/sent", f"{root}/landed"
    changes = _with_undated(fixtures.changes(spark, sf_dir))
    earlier, later = _halves(changes)
    counts = _halves(fixtures.snapshots(spark, sf_dir))
    for some_changes, some_counts in zip(
        [earlier, later.unionByName(_resent(earlier))], counts, strict=True
    ):
        _send(tx.to_documents(tx.assemble_transactions(some_changes), _MICROS), sent)
        _land(some_counts, landed)
        started = start_streams(
            read_change_stream(spark, "parquet", {"path": sent}),
            read_snapshot_stream(spark, landed),
            layout,
        )
        for query in started:
            query.awaitTermination()
    return layout


@_query
def stream_snapshot_history(spark, sf_dir):
    root = work_dir(spark, "count-history")
    layout, landed = Layout(f"{root}/silver"), f"{root}/landed"
    for counts in _halves(fixtures.snapshots(spark, sf_dir)):
        _land(counts, landed)
        for query in start_snapshot_streams(read_snapshot_stream(spark, landed), layout):
            query.awaitTermination()
    return spark.read.parquet(layout.snapshots)


@_query
def stream_raw_changes(spark, sf_dir):
    root = work_dir(spark, "messages")
    layout, sent = Layout(f"{root}/silver"), f"{root}/sent"
    documents = tx.to_documents(_transactions(spark, sf_dir))
    _send(documents, sent)
    stream = read_change_stream(spark, "parquet", {"path": sent})
    start_raw_stream(stream, layout).awaitTermination()
    return spark.read.parquet(layout.raw).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "timestamp", "timestampType",
        F.col("headers").isNull().alias("no_headers"),
    )


def _by_batch(stream: DataFrame, root: str) -> DataFrame:
    """The rows of ``stream`` with the number of the micro-batch they came in."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{root}/batches/id={batch_id}"
        )

    writer = stream.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{root}/checkpoint"
    )
    triggered(writer, None).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{root}/batches").drop("id")


@_query
def stream_rate_limit(spark, sf_dir):
    root = work_dir(spark, "rate-limit")
    for counts in _halves(fixtures.snapshots(spark, sf_dir)):
        _land(counts.coalesce(1), f"{root}/landed")
    stream = read_snapshot_stream(spark, f"{root}/landed", max_files_per_trigger=1)
    counted = _by_batch(stream, root).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("n")


@_query
def stream_refresh_trigger(spark, sf_dir):
    root = work_dir(spark, "trigger")
    _land(fixtures.snapshots(spark, sf_dir), f"{root}/landed")
    history, latest = f"{root}/history", f"{root}/latest"
    stream = read_snapshot_stream(spark, f"{root}/landed")
    append_stream(stream, history, f"{root}/checkpoint").awaitTermination()

    def recompute() -> None:
        rows = spark.read.schema(schemas.SNAPSHOT).parquet(history)
        sn.latest_snapshot(rows).write.mode("overwrite").parquet(latest)

    again = spark.readStream.schema(schemas.SNAPSHOT).parquet(history)
    refresh_with(again, recompute, f"{root}/refresh", None).awaitTermination()
    return spark.read.parquet(latest)


def _gold(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """A gold table after all streams have run, refreshed before the first row and after."""
    root = work_dir(spark, "gold")
    database = f"shelfstream_gold_{root[-32:]}"
    create_database(spark, database, f"{root}/database")
    dimensions = {
        "store": fixtures.stores(spark),
        "inventory_change_type": fixtures.change_types(spark),
    }
    for name, rows in dimensions.items():
        save_dataset(rows, f"{database}.{name}", name, {}, f"{root}/{name}")
    refresh_gold(spark, database, Layout(f"{root}/empty"), location=f"{root}/tables")
    refresh_gold(spark, database, _run_streams(spark, sf_dir), location=f"{root}/tables")
    return read_dataset(spark, f"{database}.{dataset}")


@_query
def stream_inventory_current(spark, sf_dir):
    return _gold(spark, sf_dir, "inventory_current")


@_query
def stream_inventory_bi(spark, sf_dir):
    return _gold(spark, sf_dir, "inventory_current_transformed")

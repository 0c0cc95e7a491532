"""What the physical plans must look like for the operators to hold at scale."""

import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from shelfstream import (
    current_inventory,
    dedup_changes,
    effective_changes,
    event_gaps,
    inventory_for_bi,
    latest_snapshot,
    recent_changes,
    schemas,
    snapshot_release,
    write_snapshot_files,
)
from shelfstream.operators.transactions import (
    assemble_first_transactions,
    assemble_transactions,
    split_documents,
    split_lines,
)
from shelfstream.sources import read_change_type, read_landed_snapshots, read_store


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Tables on disk; half of all changes are of one item of one store."""
    root = tmp_path_factory.mktemp("tables")
    when = F.timestamp_seconds(1609459200 + F.col("id") % 5000)
    hot = F.col("id") % 2 == 0
    changes = spark.range(20_000, numPartitions=8).select(
        F.col("id").cast("string").alias("trans_id"),
        F.when(hot, 1).otherwise(F.col("id") % 2).cast("int").alias("store_id"),
        when.alias("date_time"),
        (1 + F.col("id") % 4).cast("int").alias("change_type_id"),
        F.when(hot, 7).otherwise(F.col("id") % 50).cast("int").alias("item_id"),
        (F.col("id") % 10 - 5).cast("int").alias("quantity"),
    )
    changes.write.parquet(str(root / "changes"))
    counts = spark.range(2_000).select(
        (F.col("id") % 50).cast("int").alias("item_id"),
        F.lit(5).alias("employee_id"),
        (F.col("id") % 2).cast("int").alias("store_id"),
        F.timestamp_seconds(1609459200 + F.col("id") % 900).alias("date_time"),
        F.lit(10).alias("quantity"),
    )
    counts.write.parquet(str(root / "counts"))
    (root / "store").write_text("store_id,name\n0,online\n1,store_001\n")
    (root / "type").write_text("change_type_id,change_type\n1,sale\n2,shrink\n3,restock\n4,bopis\n")
    return {
        "root": root,
        "changes": spark.read.parquet(str(root / "changes")),
        "counts": spark.read.parquet(str(root / "counts")),
        "stores": read_store(spark, str(root / "store")),
        "types": read_change_type(spark, str(root / "type")),
    }


def effective(data):
    return effective_changes(data["changes"], data["stores"], data["types"])


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?m)^[^\n]*\bExchange (?:hash|range|Single|RoundRobin)", plan))


def test_dimensions_are_broadcast_by_size_and_columns_pruned(data):
    plan = plan_of(effective(data), final=False)
    assert plan.count("BroadcastHashJoin") == 2
    assert shuffles(plan) == 0
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "trans_id" not in scan


def test_dimensions_beyond_the_broadcast_size_are_shuffled(data, conf):
    want = rows(effective(data))
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    df = effective(data)
    assert rows(df) == want
    assert "BroadcastHashJoin" not in plan_of(df)


def test_few_counts_are_broadcast_and_changes_summed_where_read(data, spark):
    latest = latest_snapshot(data["counts"])
    latest.write.mode("overwrite").parquet(str(data["root"] / "latest"))
    stored = spark.read.parquet(str(data["root"] / "latest"))
    plan = plan_of(current_inventory(stored, effective(data)), final=False)
    # Below the first step of the sums nothing is shuffled.
    assert shuffles(plan.split("partial_sum(quantity", 1)[1]) == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_counts_are_read_and_shuffled_once_for_current_inventory(data, conf, threshold):
    conf(autoBroadcastJoinThreshold=threshold, adaptive__autoBroadcastJoinThreshold=threshold)
    # A Parquet scan of counts leaves out rows with a NULL in their key; those have their own.
    plan = plan_of(current_inventory(latest_snapshot(data["counts"]), effective(data)))
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    counts = [x for x in re.findall(r"FileScan parquet \[[^\n]*", final) if "employee_id" in x]
    assert len([x for x in counts if "isnull(" not in x]) == 1


def test_hot_key_of_a_shuffled_join_is_split(data, conf):
    latest = latest_snapshot(data["counts"])
    want = rows(current_inventory(latest, effective(data)))
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    df = current_inventory(latest, effective(data))
    assert rows(df) == want
    assert "SortMergeJoin(skew=true)" in plan_of(df)


@pytest.mark.parametrize("name", ["counts", "changes"])
def test_one_row_per_key_leaves_each_input_partition(data, name):
    df = latest_snapshot(data["counts"]) if name == "counts" else dedup_changes(data["changes"])
    plan = plan_of(df, final=False)
    assert shuffles(plan) == 1
    assert plan.count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan.split("Exchange hash", 1)[1]


def test_report_counts_changes_before_its_join(data):
    current = current_inventory(latest_snapshot(data["counts"]), effective(data))
    plan = plan_of(inventory_for_bi(current, data["changes"], data["types"]), final=False)
    # Rows are shuffled apart between the two steps of the fan-out, in a fixed number.
    outer, inner = plan.split("REPARTITION_BY_NUM", 1)
    assert outer.count("Generate explode(sequence(1,") == 1
    assert inner.count("Generate explode(sequence(0,") == 1
    assert "partial_count(1)" in inner


def scans(plan: str, tables: int) -> None:
    """As many scans as tables: what is read twice comes from one exchange."""
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", final)) == tables
    assert "ReusedExchange" in final


def test_time_order_goes_by_ranges(data):
    for df, tables in (
        (event_gaps(data["changes"]), 1),
        (snapshot_release(data["counts"], data["changes"]), 2),
    ):
        plan = plan_of(df)
        scans(plan, tables)
        # The one unpartitioned window is over a row per range.
        single = plan.split("== Initial Plan ==")[0].split("Exchange SinglePartition")[1:]
        assert len(single) == 1
        assert re.search(r"HashAggregate\(keys=\[range", single[0].split("Exchange", 1)[0])
        assert "Exchange rangepartitioning" in plan


@pytest.mark.parametrize("by_store", [False, True])
def test_a_hot_moment_is_cut_into_ranges(data, spark, by_store):
    """Half of all transactions are of one moment; no range holds them all."""
    hot = data["changes"].withColumn(
        "date_time", F.expr("CASE WHEN item_id = 7 THEN timestamp '2021-01-01 00:10:00' ELSE date_time END")
    )
    sizes = event_gaps(hot, by_store).groupBy(F.spark_partition_id()).count().collect()
    plan = plan_of(event_gaps(hot, by_store), final=False)
    asc = "store_id#\\d+ ASC NULLS FIRST, " if by_store else ""
    assert re.search(rf"Exchange rangepartitioning\({asc}date_time#\d+ ASC NULLS FIRST, trans_id", plan)
    assert sum(r["count"] for r in sizes) == hot.count()


def test_partitions_send_lines_of_first_transactions_only(data, conf):
    plan = plan_of(assemble_first_transactions(data["changes"], 5), final=False)
    assert plan.count("FileScan") == 1
    # A limit under each of both shuffles of lines: of the shares and of all.
    for shuffle in ("Exchange hashpartitioning(_share", "Exchange SinglePartition"):
        assert re.match(r"[^\n]*\n[^\n]*WindowGroupLimit [^\n]*dense_rank\([^\n]*, 5, Partial", plan.split(shuffle)[1])
    conf(optimizer__windowGroupLimitThreshold="4")
    plan = plan_of(assemble_first_transactions(data["changes"], 5), final=False)
    assert "TakeOrderedAndProject(limit=5" in plan


def test_long_transactions_are_known_before_lists(data):
    plan = plan_of(split_lines(data["changes"]), final=False)
    lists, lengths = plan.split("Join", 1)
    assert "collect_list" in lists and "collect_list" not in lengths
    assert "partial_sum" in lengths
    assert re.search(r"Exchange hashpartitioning\(date_time#\d+, trans_id#\d+, _long#\d+, _line", lists)


def test_transactions_read_and_shuffle_their_lines_once(data):
    plan = plan_of(split_documents(assemble_transactions(data["changes"])), final=False)
    assert plan.count("FileScan") == shuffles(plan) == 1
    assert "Limit" not in plan and "Broadcast" not in plan


def test_history_before_the_oldest_count_is_not_read(data, spark):
    root = str(data["root"] / "dated")
    days = data["changes"].withColumn(
        "date_time", F.expr("date_time + make_interval(0, 0, 0, item_id % 5)")
    ).withColumn("event_date", F.to_date("date_time"))
    days.write.mode("overwrite").partitionBy("event_date").parquet(root)
    late = data["counts"].withColumn("date_time", F.expr("date_time + interval 3 days"))
    latest = latest_snapshot(late)
    dated = spark.read.parquet(root)
    df = recent_changes(dated, latest)
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ >= [^\]]*[Ss]ubquery", plan)
    oldest = latest.agg(F.min("date_time")).first()[0]
    assert df.count() == dated.filter(F.col("date_time") >= oldest).count() > 0


def test_large_count_is_written_by_several_tasks(data, spark, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="4KB")
    one_time = data["changes"].selectExpr(
        "item_id", "5 as employee_id", "1 as store_id",
        "timestamp '2021-01-01 00:00:00' as date_time", "cast(trans_id as int) as quantity",
    )
    path = str(data["root"] / "landed")
    write_snapshot_files(one_time, path)
    assert len(list((data["root"] / "landed").rglob("*.csv"))) > 3
    back = read_landed_snapshots(spark, path)
    assert back.columns == [f.name for f in schemas.struct_type(schemas.SNAPSHOT)]
    assert rows(back) == rows(one_time)


def test_many_small_counts_are_written_by_many_tasks(data, spark, conf):
    """A folder costs a file however few its rows: they do not meet in one task."""
    conf(shuffle__partitions="8", adaptive__coalescePartitions__enabled="true")
    many = spark.range(60).selectExpr(
        "cast(id as int) as item_id", "5 as employee_id", "cast(id % 2 as int) as store_id",
        "timestamp '2021-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as date_time",
        "1 as quantity",
    )
    path = str(data["root"] / "landed-many")
    write_snapshot_files(many, path)
    files = list((data["root"] / "landed-many").rglob("*.csv"))
    assert len(files) == 60
    assert len({f.name.split("-")[1] for f in files}) > 3
    assert (data["root"] / "landed-many" / "_SUCCESS").exists()
    assert rows(read_landed_snapshots(spark, path)) == rows(many)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"

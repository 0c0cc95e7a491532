import re

import pytest
from conftest import at, plan_of, rows
from pyspark.sql import functions as F

from shelfstream import publish, save_dataset, schemas, storage, write_snapshot_files
from shelfstream.operators.transactions import assemble_transactions, to_documents
from shelfstream.sinks import create_database, drop_database, use_database
from shelfstream.sources.messages import LIVE_SAMPLE
from shelfstream.sources import (
    kafka_options,
    read_change_stream,
    read_change_type,
    read_changes,
    read_dataset,
    read_item,
    read_landed_snapshots,
    read_snapshots,
    read_store,
)

T1 = at("01:00:00")


def test_dimension_files_with_carriage_returns(spark, tmp_path):
    (tmp_path / "store").write_bytes(b"store_id,name\r\n0,online\r\n1,store_001\r\n")
    (tmp_path / "type").write_bytes(b"change_type_id,change_type\n1,sale\n-1,snapshot")
    (tmp_path / "item").write_bytes(b"a,b,c,d\n7,nut,3,40\n8,,,\n")
    assert rows(read_store(spark, str(tmp_path / "store"))) == [(0, "online"), (1, "store_001")]
    assert rows(read_change_type(spark, str(tmp_path / "type"))) == [(-1, "snapshot"), (1, "sale")]
    assert rows(read_item(spark, str(tmp_path / "item"))) == [
        (7, "nut", 3, 40), (8, None, None, None)]


def test_several_files_are_one_table(spark, tmp_path):
    head = "trans_id,item_id,store_id,date_time,quantity,change_type_id\n"
    (tmp_path / "a").write_text(head + "{A},1,1,2021-01-01 01:00:00,-1,1\n")
    (tmp_path / "b").write_text(head + "{B},1,0,2021-01-01 01:00:00,-1,4\n")
    got = read_changes(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows(got) == [("{A}", 1, 1, T1, -1, 1), ("{B}", 1, 0, T1, -1, 4)]
    counts = "item_id,employee_id,store_id,date_time,quantity\n1,5,0,2021-01-01 01:00:00,9\n"
    (tmp_path / "c").write_text(counts)
    (tmp_path / "d").write_text(counts)
    assert read_snapshots(spark, [str(tmp_path / "c"), str(tmp_path / "d")]).count() == 2


def test_kafka_options_come_from_the_caller():
    own = {"subscribe": "t", "kafka.bootstrap.servers": "h:1", "kafka.sasl.jaas.config": "x"}
    got = kafka_options({**own, "maxOffsetsPerTrigger": "5000"})
    assert got["maxOffsetsPerTrigger"] == "5000"
    assert got["kafka.security.protocol"] == "SASL_SSL"
    assert (got["startingOffsets"], got["failOnDataLoss"]) == ("earliest", "true")
    assert "maxOffsetsPerTrigger" not in kafka_options(own)
    few = kafka_options(own, LIVE_SAMPLE)
    assert (few["maxOffsetsPerTrigger"], few["startingOffsets"]) == ("100", "latest")
    with pytest.raises(ValueError, match="kafka.sasl.jaas.config"):
        kafka_options({"subscribe": "t", "kafka.bootstrap.servers": "h:1"})


def test_envelope_files_stand_in_for_messages(spark, tmp_path):
    stream = read_change_stream(spark, "parquet", {"path": str(tmp_path)})
    assert stream.isStreaming
    assert stream.columns == ["key", "value", "topic", "partition", "offset", "timestamp",
                              "timestampType", "headers"]


def test_count_files(spark, tmp_path):
    data = [(i, 5, s, at(f"{h:02}:00:00"), i) for i in range(30) for s in (0, 1) for h in (1, 2)]
    counts = spark.createDataFrame(data, schemas.SNAPSHOT)
    path = str(tmp_path / "counts")
    write_snapshot_files(counts.limit(3), path)
    write_snapshot_files(counts, path)
    assert rows(read_landed_snapshots(spark, path)) == rows(counts)
    folders = {str(f.relative_to(path).parent) for f in (tmp_path / "counts").rglob("*.csv")}
    assert folders == {f"store={s}/taken=2021-01-01 {h:02}%3A00%3A00" for s in (0, 1)
                       for h in (1, 2)}
    files = list((tmp_path / "counts").rglob("*.csv"))
    for file in files:
        head, *body = file.read_text().splitlines()
        assert head == "id,item_id,employee_id,store_id,date_time,quantity"
        assert all(re.match(r"\d+,", line) for line in body)
    one = read_landed_snapshots(spark, path, 1, "2021-01-01 02:00:00")
    assert rows(one) == rows(counts.filter("store_id = 1 AND hour(date_time) = 2"))
    folders = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(one)).group(1)
    assert "store#" in folders and "taken#" in folders
    indexes = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert max(map(int, indexes)) < len(data)


def test_publish_text(spark, tmp_path):
    line = spark.createDataFrame([("A", 1, 1, T1, -1, 1)], schemas.CHANGE_LINE)
    documents = to_documents(assemble_transactions(line))
    publish(documents, "text", {"path": str(tmp_path / "out")})
    assert spark.read.text(str(tmp_path / "out")).first()[0] == documents.first().document
    with pytest.raises(ValueError, match="pigeon"):
        publish(documents, "pigeon", {})


@pytest.fixture
def database(spark):
    name = "shelf_test"
    create_database(spark, name)
    yield name
    spark.sql("USE default")
    drop_database(spark, name)
    assert name not in [d.name for d in spark.catalog.listDatabases()]


def _details(spark, name):
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def test_saved_dataset(spark, database, tmp_path):
    name, base = f"{database}.t", str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    save_dataset(one, name, "it's a comment", {"quality": "gold"}, base)
    assert rows(read_dataset(spark, name)) == [(1, "a")]
    assert _details(spark, name)["Comment"] == "it's a comment"
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["quality"] == "gold"
    use_database(spark, database)
    assert rows(spark.sql("SELECT * FROM t")) == [(1, "a")]

    # A refresh replaces rows, and may read what it replaces.
    twice = spark.table(name).union(spark.table(name))
    save_dataset(twice, name, "second", {"quality": "silver"}, base)
    assert rows(spark.table(name)) == [(1, "a")] * 2
    assert _details(spark, name)["Comment"] == "second"
    assert len(storage.child_names(spark, base)) == 2

    # Other columns make another table; folders before it are kept for running queries.
    running = spark.table(name)
    other = spark.createDataFrame([("x", 2.0)], "a string, b double")
    for n in (1, 2):
        save_dataset(other, name, "third", {}, base, partition_by=["a"])
        assert rows(spark.table(name).select("a", "b")) == [("x", 2.0)]
        assert len(storage.child_names(spark, base)) == 2 + n
        assert rows(running) == [(1, "a")] * 2
    # Folders go once they have been replaced for longer than they are kept.
    save_dataset(other, name, "last", {}, base, partition_by=["a"], keep_hours=0)
    assert len(storage.child_names(spark, base)) == 1


def test_failed_refresh_keeps_the_rows_before(spark, database, tmp_path):
    name, base = f"{database}.t", str(tmp_path / "t")
    good = spark.createDataFrame([(1, 2)], "k int, v int")
    save_dataset(good, name, "c", {"quality": "gold"}, base)
    bad = good.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        save_dataset(bad, name, "c", {"quality": "gold"}, base)
    assert rows(spark.table(name)) == [(1, 2)]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert storage.work_dir(spark, "x").startswith(named + "/x-")
    assert storage.work_dir(spark, "x") != storage.work_dir(spark, "x")

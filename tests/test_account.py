"""The numbers of a stream that leaves changes out."""

from conftest import rows
from test_streaming import document, send

from shelfstream.sources import read_change_stream
from shelfstream.streaming import Account, account_of, accounted_changes, append_stream


class Run:
    def __init__(self, spark, root, mode="watermark"):
        self.spark, self.raw, self.mode = spark, root / "raw", mode
        self.out, self.checkpoint = str(root / "out"), str(root / "checkpoint")
        self.raw.mkdir(parents=True)

    def __call__(self, *batches):
        for payloads in batches:
            send(self.spark, self.raw, *payloads)
        options = {"path": str(self.raw), "maxFilesPerTrigger": "1"}
        stream = accounted_changes(read_change_stream(self.spark, "parquet", options), mode=self.mode)
        query = append_stream(stream, self.out, self.checkpoint)
        query.awaitTermination()
        return account_of(query.recentProgress)


def test_every_change_is_accounted_for(spark, tmp_path):
    run = Run(spark, tmp_path)
    first = run(
        # What is late is judged by the watermark two micro-batches before.
        [document("A", 9, (1, -1), (2, -2))],
        [document("A", 9, (1, -1)), "garbage", "{}"],
        [document("B", 9, (1, -1)), document("LATE", 2, (1, -1), (2, -1)), "garbage", document("N", 9)],
    )
    assert first == Account(messages=8, unparseable=3, changes=10, undated=3, late=2, repeated=3, kept=5)
    # A later run goes on from the same state; its account is its own.
    second = run([document("A", 9, (2, -2)), document("C", 10, (5, 1))])
    assert second == Account(messages=2, changes=2, repeated=1, kept=1)
    assert (first + second).kept == spark.read.parquet(run.out).count() == 6
    total = first + second
    assert total.kept + total.late + total.repeated == total.changes


def test_modes_leave_out_what_they_say(spark, tmp_path):
    batches = [[document("A", 9, (1, -1))], ["garbage"], [document("OLD", 2, (1, -1)), "garbage"]]
    got = {m: Run(spark, tmp_path / m, m)(*batches) for m in ("exact", "watermark", "bounded")}
    assert [(a.late, a.repeated, a.kept) for a in got.values()] == [(0, 1, 3), (1, 1, 2), (1, 2, 1)]


def test_the_rows_are_those_of_the_plain_stream(spark, tmp_path):
    from shelfstream.streaming import change_stream

    run = Run(spark, tmp_path)
    run([document("A", 9, (1, -1), (2, -2))], ["garbage"], [document("LATE", 2, (1, -1)), document("A", 9, (1, -1))])
    stream = change_stream(
        read_change_stream(spark, "parquet", {"path": str(run.raw), "maxFilesPerTrigger": "1"}), mode="watermark"
    )
    append_stream(stream, str(tmp_path / "plain"), str(tmp_path / "other")).awaitTermination()
    assert rows(spark.read.parquet(run.out)) == rows(spark.read.parquet(str(tmp_path / "plain")))


def test_nothing_read():
    assert account_of([]) == Account()

"""Change lines to transaction documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstream.functions import item_struct, strip_braces as strip_braces_of

# Fixed value: the longest document a message may hold, 256 KiB.
MAX_OCTETS = 256 * 1024

TXN = ["date_time", "trans_id"]
HEADER = ["date_time", "trans_id", "store_id", "change_type_id"]

# Upper bounds that spare writing most documents: an item with its comma, the rest of a
# document but for its id and time, and a character of the id (\u0000).
_MOST_ITEM_OCTETS = 48
_MOST_HEADER_OCTETS = 250
_MOST_ID_OCTETS = 6

# First transactions are looked for in so many shares before they are compared in one task.
_SHARES = 32
# Copies of a line that are unrolled at a time.
_REPEATS = 100_000


def strip_braces(df: DataFrame, col: str = "trans_id") -> DataFrame:
    """Cut the braces around transaction ids. Do not apply twice."""
    return df.withColumn(col, strip_braces_of(col))


def assemble_transactions(lines: DataFrame) -> DataFrame:
    """One row per transaction: the header and the list of its items, sorted.

    The key is (date_time, trans_id); the header takes the least store and change type,
    so a rerun gives the same rows. Lines are shuffled once. A transaction is one row, so
    its list has to fit in one.
    """
    # Lists do not get smaller by combining them early: shuffle plain lines.
    return _assembled(lines.select(*HEADER, "item_id", "quantity").repartition(*TXN))


def _assembled(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy(*TXN)
        .agg(
            F.min("store_id").alias("store_id"),
            F.min("change_type_id").alias("change_type_id"),
            F.sort_array(F.collect_list(item_struct("item_id", "quantity"))).alias("items"),
        )
        .select(*HEADER, "items")
    )


def assemble_first_transactions(lines: DataFrame, n: int = 100) -> DataFrame:
    """As :func:`assemble_transactions`, for the first ``n`` transactions, in their order.

    Lines are read once, and only those of first transactions leave a partition: of its own
    first ``n``, then of the first ``n`` of a share of all transactions, then of all. Spark limits
    a window before its shuffle up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000);
    beyond that the keys of the first transactions are found by themselves, and their lines
    by a second read.
    """
    spark = lines.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return _assemble_by_first_keys(lines, n)
    share = F.pmod(F.xxhash64(*TXN), F.lit(_SHARES))
    some = _first_places(lines.withColumn("_share", share), Window.partitionBy("_share"), n).drop("_share")
    return _assembled(_first_places(some, Window, n)).orderBy(*TXN)


def _first_places(lines: DataFrame, window, n: int) -> DataFrame:
    place = F.dense_rank().over(window.orderBy(*TXN))
    return lines.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def _assemble_by_first_keys(lines: DataFrame, n: int) -> DataFrame:
    copies = {c: f"_{c}" for c in TXN}
    first = (
        lines.select(*TXN).distinct().orderBy(*TXN).limit(n).withColumnsRenamed(copies)
    )
    same = [F.col(c).eqNullSafe(F.col(copy)) for c, copy in copies.items()]
    return assemble_transactions(lines.join(first, same)).orderBy(*TXN)


def split_lines(
    lines: DataFrame, max_octets: int = MAX_OCTETS, timestamp_format: str | None = None
) -> DataFrame:
    """Transactions of ``lines``; one with a document over ``max_octets`` as one-item ones.

    As :func:`split_documents` of :func:`assemble_transactions`, but the length of a document
    is summed up before there is a list: a transaction that is cut never becomes one, and its
    lines are dealt out by what they say. Equal lines of such a transaction are counted and
    repeated. Lines are read twice; whether the keys of the long transactions are broadcast is
    left to Spark.
    """
    item = item_struct("item_id", "quantity")
    header = [F.min(c).alias(c) for c in HEADER[2:]]
    octets = F.sum(F.octet_length(F.to_json(item)) + 1).alias("_octets")
    no_items = F.filter(F.array(item_struct(F.lit(0), F.lit(0))), lambda _: F.lit(False))
    empty = F.octet_length(_document(timestamp_format, no_items))
    copies = {c: f"_{c}" for c in HEADER}
    long = (
        lines.groupBy(*TXN).agg(*header, octets)
        .filter(empty + F.col("_octets") - 1 > max_octets)
        .drop("_octets").withColumnsRenamed(copies).withColumn("_long", F.lit(True))
    )
    same = [F.col(c).eqNullSafe(F.col(copies[c])) for c in TXN]
    is_long = F.coalesce("_long", F.lit(False))
    marked = lines.select(*HEADER, "item_id", "quantity").join(long, same, "left").select(
        *TXN,
        *[F.when(is_long, F.col(copies[c])).otherwise(F.col(c)).alias(c) for c in HEADER[2:]],
        is_long.alias("_long"),
        F.when(is_long, item).alias("_line"),
        F.when(~is_long, item).alias("_item"),
    )
    key = [*TXN, "_long", "_line"]
    grouped = marked.repartition(*key).groupBy(*key).agg(
        *header, F.count(F.lit(1)).alias("_times"), F.sort_array(F.collect_list("_item")).alias("_items")
    )
    one = F.lit(1).cast("bigint")
    times = F.when(F.col("_long"), F.col("_times")).otherwise(one)
    # Two steps, so that no array of repeats is longer than a block.
    blocks = grouped.withColumn("_times", times).withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_times - 1) div {_REPEATS})"))
    )
    copies_of = F.sequence(one, F.least(F.lit(_REPEATS).cast("bigint"), F.col("_times") - F.col("_block") * _REPEATS))
    return blocks.withColumn("_copy", F.explode(copies_of)).select(
        *HEADER, F.when(F.col("_long"), F.array("_line")).otherwise(F.col("_items")).alias("items")
    )


def split_documents(
    txns: DataFrame, max_octets: int = MAX_OCTETS, timestamp_format: str | None = None
) -> DataFrame:
    """Cut each transaction with a document over ``max_octets`` into one-item ones.

    The document measured is the one :func:`to_documents` writes with the same
    ``timestamp_format``.
    """
    header = _MOST_HEADER_OCTETS + 3 * len(timestamp_format or "")
    id_octets = F.coalesce(F.octet_length("trans_id"), F.lit(0)) * _MOST_ID_OCTETS
    at_most = F.size("items") * _MOST_ITEM_OCTETS + id_octets + header
    too_long = (at_most > max_octets) & (F.octet_length(_document(timestamp_format)) > max_octets)
    singles = F.transform("items", lambda item: F.array(item))
    pieces = F.when(too_long, singles).otherwise(F.array("items"))
    return txns.select(*HEADER, F.explode(pieces).alias("items"))


def _document(timestamp_format: str | None, items: Column | str = "items") -> Column:
    options = {"timestampFormat": timestamp_format} if timestamp_format else {}
    items = F.col(items) if isinstance(items, str) else items
    return F.to_json(F.struct(*HEADER, items.alias("items")), options)


def to_documents(txns: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """One JSON document per transaction, in column ``document``, next to its header.

    Spark writes times to the millisecond unless ``timestamp_format`` says otherwise.
    """
    return txns.select(*HEADER, _document(timestamp_format).alias("document"))


def first_transactions(txns: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` transactions in (date_time, trans_id) order."""
    return txns.orderBy(*TXN).limit(n)

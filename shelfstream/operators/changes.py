"""Messages to item-level inventory changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.operators.ranking import first_per_key
from shelfstream.schemas import EVENT

CHANGE_KEY = ["trans_id", "item_id"]
CHANGE_COLUMNS = [
    "trans_id", "store_id", "date_time", "change_type_id", "item_id", "quantity",
]

# The one combination that is booked by another store.
ONLINE = "online"
BOPIS = "bopis"


def parse_events(
    raw: DataFrame, schema: str = EVENT, options: dict[str, str] | None = None
) -> DataFrame:
    """Decode the payload of each message into the struct column ``event``.

    A payload that is no document gives an all-NULL event, a bad field a NULL field.
    """
    body = F.col("value").cast("string")
    return raw.select(F.from_json(body, schema, options or {}).alias("event"))


def flatten_events(events: DataFrame, keep_event: bool = False) -> DataFrame:
    """One row per item of each event; an event without items keeps one row.

    ``keep_event`` also carries the whole document on each of its rows, which makes the
    output grow with the square of the number of items in a document.
    """
    carried = ["event"] if keep_event else []
    header = [F.col(f"event.{c}") for c in CHANGE_COLUMNS[:4]]
    return events.select(*carried, *header, F.explode_outer("event.items").alias("item")).select(
        *carried, *CHANGE_COLUMNS[:4], "item.item_id", "item.quantity"
    )


def malformed_changes(changes: DataFrame) -> DataFrame:
    """Changes without an event time: no watermark ever makes them late."""
    return changes.filter(F.col("date_time").isNull())


def dedup_changes(
    changes: DataFrame, delay: str = "1 hour", mode: str = "exact"
) -> DataFrame:
    """One change per (trans_id, item_id).

    On a batch the change with the least (date_time, quantity) is kept, dated ones first.
    Copies are dropped before the shuffle.

    On a stream the first to arrive is kept. ``mode="exact"`` keeps one row per key whatever
    the time of a resend, undated ones included, and drops nothing for being late; its state
    has one entry per key, on the executors' disks, and grows as the output does.
    ``mode="watermark"`` is the same but for rows later than ``delay``, which are dropped.
    ``mode="bounded"`` also lets go of a key once its time has passed, for sources that
    resend within ``delay`` only, and takes dated changes only (see
    :func:`malformed_changes`).
    """
    if mode not in ("exact", "watermark", "bounded"):
        raise ValueError(f"unknown mode {mode!r}")
    if not changes.isStreaming:
        return _least_per_key(changes)
    if mode == "exact":
        return changes.dropDuplicates(CHANGE_KEY)
    if mode == "watermark":
        return changes.withWatermark("date_time", delay).dropDuplicates(CHANGE_KEY)
    dated = changes.filter(F.col("date_time").isNotNull())
    return dated.withWatermark("date_time", delay).dropDuplicatesWithinWatermark(CHANGE_KEY)


def _least_per_key(changes: DataFrame) -> DataFrame:
    rank = ["date_time", "quantity"]
    rest = [c for c in changes.columns if c not in (*CHANGE_KEY, *rank)]
    order = [F.asc_nulls_last("date_time"), *[F.asc(c) for c in ("quantity", *rest)]]
    return first_per_key(changes, CHANGE_KEY, order)


def effective_changes(
    changes: DataFrame, stores: DataFrame, change_types: DataFrame
) -> DataFrame:
    """Changes that move stock where they were recorded.

    A pick-up order taken by the online store leaves the shelf of another store, which
    records it as well, so the online record is dropped. Changes of unknown stores or
    types are dropped by the inner joins. The filter is three-valued: a NULL store name
    with a pick-up order is dropped, with any other type it is kept.

    No broadcast is forced: Spark broadcasts a dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond.
    """
    moves = changes.select("store_id", "item_id", "date_time", "quantity", "change_type_id")
    return _booked_here(moves, stores, change_types).select(
        "store_id", "item_id", "date_time", "quantity"
    )


def effective_sums(sums: DataFrame, stores: DataFrame, change_types: DataFrame) -> DataFrame:
    """As :func:`effective_changes`, of sums per (store, item, change type) and day."""
    return _booked_here(sums, stores, change_types).select(
        "store_id", "item_id", "event_date", "moved", "moved_at"
    )


def _booked_here(moves: DataFrame, stores: DataFrame, change_types: DataFrame) -> DataFrame:
    booked_elsewhere = (F.col("name") == ONLINE) & (F.col("change_type") == BOPIS)
    return (
        moves.join(stores.select("store_id", "name"), "store_id")
        .join(change_types.select("change_type_id", "change_type"), "change_type_id")
        .filter(~booked_elsewhere)
    )


def changes_of(changes: DataFrame, trans_id: str) -> DataFrame:
    """The changes of one transaction."""
    return changes.filter(F.col("trans_id") == trans_id)

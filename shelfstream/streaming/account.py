"""What a change stream takes in, leaves out, and why."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.operators.changes import dedup_changes, flatten_events, parse_events
from shelfstream.schemas import EVENT, struct_type

_MESSAGES, _CHANGES, _KEPT = "messages_in", "changes_in", "changes_out"


@dataclass(frozen=True)
class Account:
    """Numbers of a run of :func:`accounted_changes`; kept + late + repeated = changes."""

    #: Messages read, and those of them that are no document.
    messages: int = 0
    unparseable: int = 0
    #: Changes in them (an unparseable message or one without items is one), and the undated.
    changes: int = 0
    undated: int = 0
    #: Changes behind the watermark, those that have been there before, and the rest.
    late: int = 0
    repeated: int = 0
    kept: int = 0

    def __add__(self, other: Account) -> Account:
        return Account(*[getattr(self, f.name) + getattr(other, f.name) for f in fields(self)])


def accounted_changes(raw: DataFrame, delay: str = "1 hour", mode: str = "watermark") -> DataFrame:
    """Messages to deduplicated changes, as by ``change_stream``, counted on their way.

    The numbers are metrics of the micro-batch that does the work: nothing is read twice. They
    stand in the progress of the query (:func:`account_of`). ``mode="bounded"`` leaves undated
    changes out before it deduplicates; they then count as repeated.
    """
    something = F.lit(False)
    for f in struct_type(EVENT):
        something |= F.col(f"event.{f.name}").isNotNull()
    one = F.count(F.lit(1))
    events = parse_events(raw).observe(
        _MESSAGES, one.alias("messages"), F.count_if(~something).alias("unparseable")
    )
    changes = flatten_events(events).observe(
        _CHANGES, one.alias("changes"), F.count_if(F.col("date_time").isNull()).alias("undated")
    )
    return dedup_changes(changes, delay, mode).observe(_KEPT, one.alias("kept"))


def account_of(progress: Iterable) -> Account:
    """The sum over micro-batches, given as a query's progress reports.

    ``query.recentProgress`` has the last 100 (``spark.sql.streaming.numRecentProgressUpdates``);
    a listener can gather those of a longer run, and accounts add up.
    """
    total = Account()
    for batch in progress:
        observed = batch["observedMetrics"]
        if _KEPT not in observed:
            continue
        messages, changes = observed[_MESSAGES].asDict(), observed[_CHANGES].asDict()
        kept = observed[_KEPT]["kept"]
        late = sum(s["numRowsDroppedByWatermark"] for s in batch["stateOperators"])
        repeated = changes["changes"] - late - kept
        total += Account(**messages, **changes, late=late, repeated=repeated, kept=kept)
    return total

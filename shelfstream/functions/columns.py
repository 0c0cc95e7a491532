"""Scalar functions, all of them compositions of built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfstream.schemas import SECOND_FORMAT

# Report labels by store id.
STORE_LABELS = {1: "Store_01", 0: "Online_01"}
OTHER_STORE_LABEL = "Something_new"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_braces(c: Column | str) -> Column:
    """Cut the first and the last character, whatever they are (FN1)."""
    c = _col(c)
    return F.substring(c, F.lit(2), F.length(c) - 2)


def item_struct(item_id: Column | str, quantity: Column | str) -> Column:
    """One entry of a document's item list (FN2)."""
    return F.struct(_col(item_id).alias("item_id"), _col(quantity).alias("quantity"))


def as_second_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp (FN7)."""
    return F.date_format(_col(c), SECOND_FORMAT)


def as_document_time(c: Column | str) -> Column:
    """Instant of a document's ISO time text, NULL when it is not one (FN14)."""
    return F.try_to_timestamp(_col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))


def store_label(c: Column | str) -> Column:
    """Report label of a store id; unknown and NULL ids share the default (FN10)."""
    c = _col(c)
    labelled = F
    for store_id, label in STORE_LABELS.items():
        labelled = labelled.when(c == store_id, F.lit(label))
    return labelled.otherwise(F.lit(OTHER_STORE_LABEL))


def or_zero(c: Column | str) -> Column:
    """NULL counts as nothing moved (FN11)."""
    return F.coalesce(_col(c), F.lit(0))

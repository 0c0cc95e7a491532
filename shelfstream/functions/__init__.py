"""Column functions."""

from shelfstream.functions.columns import (
    as_document_time,
    as_second_text,
    item_struct,
    or_zero,
    store_label,
    strip_braces,
)

__all__ = [
    "as_document_time",
    "as_second_text",
    "item_struct",
    "or_zero",
    "store_label",
    "strip_braces",
]

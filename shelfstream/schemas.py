"""Declared schemas. Nothing in this package infers a schema from data.

Fixed values: column names, order and types are the wire and file formats.
"""

from pyspark.sql.types import StructType

# -- files, bound by position under a header line -------------------------------
STORE = "store_id int, name string"
ITEM = "item_id int, name string, supplier_id int, safety_stock_quantity int"
CHANGE_TYPE = "change_type_id int, change_type string"
CHANGE_LINE = (
    "trans_id string, item_id int, store_id int, date_time timestamp, "
    "quantity int, change_type_id int"
)
SNAPSHOT = (
    "item_id int, employee_id int, store_id int, date_time timestamp, quantity int"
)
CHANGE = (
    "trans_id string, store_id int, date_time timestamp, change_type_id int, "
    "item_id int, quantity int"
)
# A landed count file carries a leading row index.
LANDED_SNAPSHOT = "id bigint, " + SNAPSHOT

# -- messages -------------------------------------------------------------------
EVENT = (
    "trans_id string, store_id int, date_time timestamp, change_type_id int, "
    "items array<struct<item_id: int, quantity: int>>"
)
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int, "
    "headers array<struct<key: string, value: binary>>"
)

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def struct_type(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)

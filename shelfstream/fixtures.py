"""Inputs of the engine, derived from the driver's tables.

Every function reads whole tables. Times load without a zone and are cast, under a UTC
session, to the instants the engine works on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The two dimensions.
STORES = [(0, "online"), (1, "store_001")]
CHANGE_TYPES = [
    (1, "sale"),
    (2, "shrink"),
    (3, "restock"),
    (4, "bopis"),
    (-1, "snapshot"),
]


# Schemas by path, so that a table's files are opened for theirs once.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _values(rows: list[tuple], columns: str) -> str:
    cells = ", ".join(f"({number}, '{text}')" for number, text in rows)
    return f"SELECT * FROM VALUES {cells} AS t({columns})"


def stores(spark: SparkSession) -> DataFrame:
    return spark.sql(_values(STORES, "store_id, name"))


def change_types(spark: SparkSession) -> DataFrame:
    return spark.sql(_values(CHANGE_TYPES, "change_type_id, change_type"))


_ITEM = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-level changes: every event but the views."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type <> 'view'")
        .selectExpr(
            "cast(event_id as string) as trans_id",
            "cast(user_id % 2 as int) as store_id",
            "cast(ts as timestamp) as date_time",
            """case event_type when 'purchase' then 1 when 'error' then 2
                 when 'signup' then 3 when 'click' then 4 end as change_type_id""",
            f"{_ITEM} as item_id",
            """cast(case when event_type = 'signup' then floor(value)
                 else -floor(value) end as int) as quantity""",
        )
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts: the views."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'view'")
        .selectExpr(
            f"{_ITEM} as item_id",
            "cast(user_id as int) as employee_id",
            "cast(user_id % 2 as int) as store_id",
            "cast(ts as timestamp) as date_time",
            "cast(floor(value) as int) as quantity",
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction lines as files have them, ids in braces."""
    ordered = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "concat('{', cast(l_orderkey as string), '}') as trans_id",
            "cast(l_partkey as int) as item_id",
            "cast(o_custkey % 2 as int) as store_id",
            "cast(o_orderdate as timestamp) as date_time",
            """cast(case when o_orderstatus = 'O' then l_quantity
                 else -l_quantity end as int) as quantity""",
            """case o_orderstatus when 'F' then 1 when 'O' then 3
                 else 4 end as change_type_id""",
        )
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item dimension, from parts."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as int) as item_id",
        "p_name as name",
        "cast(p_partkey % 100 as int) as supplier_id",
        "p_size as safety_stock_quantity",
    )

"""Every operator as a query over the driver's tables, and the same in SQL."""

from shelfstream.registry.oracle import ORACLE_SQL
from shelfstream.registry.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

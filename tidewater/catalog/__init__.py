"""Registered queries (Spark) and their independent SQL statements (oracle).

Every query reads the driver tables of a scale-factor folder, or data that
Spark derives from them, so its work grows with the tables.
"""

from tidewater.catalog.oracle import ORACLE_SQL
from tidewater.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

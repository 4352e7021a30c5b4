"""What the driver entry adds when this subpackage is there."""

from playerledger.llm.queries import QUERIES
from playerledger.llm.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

"""Named queries over the driver tables and their SQL oracle."""

from ledgerline.plans.oracle import ORACLE
from ledgerline.plans.registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]

"""Queries over the driver's tables."""

from trustlake.plans import flow_queries, log_queries, queries
from trustlake.plans.log_oracle import ORACLE as LOG_ORACLE
from trustlake.plans.oracle import ORACLE as TABLE_ORACLE

QUERIES, ORACLE = queries.QUERIES, TABLE_ORACLE | LOG_ORACLE | flow_queries.ORACLE

__all__ = ["ORACLE", "QUERIES", "flow_queries", "log_queries"]

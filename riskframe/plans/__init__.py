"""Query plans bound to the driver's test tables (``queries()`` / ``oracle_sql()``)."""

from riskframe.plans.registry import ORACLE, QUERIES

# importing the modules registers their queries
from riskframe.plans import q_relational, q_audit, q_prep, q_analysis, q_checks, q_learners  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLE"]

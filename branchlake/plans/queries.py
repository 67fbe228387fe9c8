"""All registered queries of the reference's operators, each with its SQL."""

from branchlake.plans import q_check, q_lake, q_load
from branchlake.plans.tables import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "q_check", "q_lake", "q_load"]

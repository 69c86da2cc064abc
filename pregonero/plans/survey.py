"""All queries of the survey's operators: each module registers its own with reference_queries.query."""

from pregonero.plans import job_queries, more_queries, page_queries, place_queries  # noqa: F401  they register their queries
from pregonero.plans.reference_queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

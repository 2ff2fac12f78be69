"""All registered queries."""

from braidlake.plans import (  # noqa: F401
    contracts,
    credit_job,
    dimensions,
    figures,
    history,
    loads,
    maintenance_job,
    party_jobs,
    relational,
    sales_job,
    settlement_jobs,
)
from braidlake.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

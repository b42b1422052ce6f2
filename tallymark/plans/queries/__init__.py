"""All registered queries."""

from tallymark.plans.queries import cases, quality, recon, reports, scalars, staging
from tallymark.plans.queries.base import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "cases", "quality", "recon", "reports", "scalars", "staging"]

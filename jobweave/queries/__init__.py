"""The registered queries: every operator bound to the shared test tables, with the same
logic as SQL for comparison."""

from __future__ import annotations

from jobweave.queries.base import REGISTRY, SQL
from jobweave.queries import (  # noqa: F401  (registration)
    catalogue,
    maintenance,
    normalized,
    places,
    probes,
    postings,
    relational,
    scalars,
    streams,
)

__all__ = ["REGISTRY", "SQL"]

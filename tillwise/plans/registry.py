"""All registered queries; importing the query modules fills the table."""

from __future__ import annotations

from tillwise.plans import model_queries  # noqa: F401
from tillwise.plans.queries import QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)

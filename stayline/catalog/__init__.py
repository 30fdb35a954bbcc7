"""All registered queries."""

from stayline.catalog import balancing, cleaning, evaluating, exploring, modelling, streams  # noqa: F401
from stayline.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

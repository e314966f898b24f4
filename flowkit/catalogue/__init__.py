"""All catalogue queries, one module per area."""

from flowkit.catalogue import checking, cleaning, flattening, operations, streams
from flowkit.catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checking", "cleaning", "flattening", "operations", "streams"]

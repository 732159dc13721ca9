"""Named queries over the test tables, with the SQL that checks them."""

from tripmart.registry import batch, current, events, messages, shapes, storage
from tripmart.registry.base import joined

_PARTS = (batch, storage, events, messages, current, shapes)
QUERIES = joined(*[part.QUERIES for part in _PARTS])
ORACLES = joined(*[part.ORACLES for part in _PARTS])

__all__ = ["ORACLES", "QUERIES"]

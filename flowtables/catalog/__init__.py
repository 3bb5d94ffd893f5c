"""All registered queries."""

from flowtables.catalog import basics, feeds, flows, logs, messages, streams  # noqa: F401
from flowtables.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

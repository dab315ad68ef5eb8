"""All registered queries."""

from __future__ import annotations

from wattledger.testbed import q_aggregates, q_by_date, q_model, q_sources, q_tables  # noqa: F401
from wattledger.testbed.registry import ORACLES, QUERIES  # noqa: F401

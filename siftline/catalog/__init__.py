"""Registered queries over the given tables, each with its SQL twin.

Importing the query modules fills the registry.
"""

from siftline.catalog.registry import QUERIES, SQL  # noqa: F401
from siftline.catalog import (  # noqa: F401  (imported for what they register)
    q_daily,
    q_history,
    q_marts,
    q_rollup,
    q_scores,
    q_sources,
    q_streams,
    q_text,
)

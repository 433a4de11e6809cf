"""Query plans: every registered query and its DuckDB oracle."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import corpus_queries, explore_queries, model_queries, stats_queries  # noqa: F401  (register queries)


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)

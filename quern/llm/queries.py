"""All queries of the subpackage."""

from quern.llm import queries_dedup, queries_mining, queries_native, queries_scan  # noqa: F401
from quern.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

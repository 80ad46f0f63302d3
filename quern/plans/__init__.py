"""All registered queries."""

from importlib import import_module

from quern.plans.registry import ORACLES, QUERIES

for _part in ("files_and_tables", "shape_and_profile", "scalars_and_text", "topics_and_models", "search_and_reports", "quality_checks", "bounds"):
    import_module(f"quern.plans.{_part}")

__all__ = ["ORACLES", "QUERIES"]

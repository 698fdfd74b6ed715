"""Registered queries and the independent SQL each one is compared with."""

from medstrata.registry.catalog import ORACLES, QUERIES


def load_all() -> None:
    """Import every module that registers queries."""
    from medstrata.registry import (  # noqa: F401
        cleaning, dashboards, extras, ingest, joins, quality, reports, upserts,
    )


__all__ = ["ORACLES", "QUERIES", "load_all"]

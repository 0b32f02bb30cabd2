"""Query registry: name -> (Spark plan builder, optional oracle SQL)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all():
    """Import every catalogue module (they register on import)."""
    from . import catalog_prep, catalog_sample, catalog_stats, catalog_eval, catalog_models, catalog_edge, catalog_fits, catalog_sources  # noqa: F401
    return QUERIES, ORACLE

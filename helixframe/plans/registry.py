"""All registered queries of the engine and their oracle SQL."""

from __future__ import annotations

from helixframe.plans import alignment, mapping, reads, sites, splits

_MODULES = (sites, mapping, reads, alignment, splits)
QUERIES: dict = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL: dict = {name: s for m in _MODULES for name, s in m.SQL.items()}

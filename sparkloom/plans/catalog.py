"""The engine's queries by name, bound to the driver's tables, and their SQL."""

from __future__ import annotations

from . import code, domain, evidence, extraction, flows, graphs, knowledge, measures, retrieval, structure  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401

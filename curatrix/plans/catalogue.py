"""The registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from . import basic, build, change, graphs, ingest, keys, match  # noqa: F401  each registers its queries
from .base import ORACLES, QUERIES  # noqa: F401

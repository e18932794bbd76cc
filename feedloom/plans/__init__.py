"""Registered end-to-end queries (what the driver entry exposes)."""

from .registry import oracle_sql, queries  # noqa: F401

"""Registered queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

from .registry import QUERIES, SQL

for _name in ("lightcurves", "alignment", "frames_calibration", "catalogue", "water", "reports", "files", "pixels", "plans", "differential"):
    import_module(f"{__name__}.{_name}")

__all__ = ["QUERIES", "SQL"]

"""Registered products, grouped by area."""

from __future__ import annotations

from importlib import import_module

AREAS = ("ingest", "semantic", "ranking", "planning", "advice", "quality", "jobs", "upkeep")


def load_products():
    import_module("outpulse.catalog.base_sql")
    for area in AREAS:
        import_module(f"outpulse.catalog.{area}")
    from outpulse.catalog.registry import PRODUCTS

    return PRODUCTS

"""Named queries by area; importing the area modules registers them."""

from __future__ import annotations

from importlib import import_module

from tillage.plans.registry import JOBS, ORACLES

AREAS = ["profiles", "rows", "statistics", "warehouse", "cubes", "mining", "models", "pipelines"]


def load() -> dict:
    for area in AREAS:
        import_module(f"tillage.plans.{area}")
    return dict(JOBS)


__all__ = ["JOBS", "ORACLES", "load"]

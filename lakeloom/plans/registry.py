"""All named reports, keyed by inventory id."""

from __future__ import annotations

import importlib

from lakeloom.plans._common import REGISTRY

_MODULES = ("sales", "joins_aggs", "analytics", "scalars", "profiling", "textprofile", "helpers", "medallion")


def load_all() -> dict:
    for m in _MODULES:
        try:
            importlib.import_module(f"lakeloom.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"lakeloom.plans.{m}":
                raise
    return REGISTRY


def queries() -> dict:
    return {k: v[0] for k, v in load_all().items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in load_all().items() if v[1] is not None}

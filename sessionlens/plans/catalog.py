"""All registered queries: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

import importlib

from sessionlens.plans.registry import REGISTRY

_MODULES = ["q_clean", "q_impute", "q_joins", "q_profile", "q_features", "q_time", "q_splits", "q_metrics", "q_models", "q_io"]


def load() -> dict:
    for m in _MODULES:
        importlib.import_module(f"sessionlens.plans.{m}")
    return REGISTRY


def queries() -> dict:
    return {k: q.build for k, q in load().items()}


def oracle_sql() -> dict:
    return {k: q.sql for k, q in load().items() if q.sql}

"""All registered checks in one place."""

from __future__ import annotations

from functools import wraps

from ..session import apply_defaults
from .oracle_models import model_sql
from .spark_models import model_queries
from . import ops_core, ops_feeds, ops_plan

CHECK_MODULES = [ops_core, ops_plan, ops_feeds]


def _with_defaults(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        apply_defaults(spark)
        return fn(spark, str(sf_dir).rstrip("/"))
    return run


def all_queries() -> dict:
    q = {}
    q.update(model_queries())
    for m in CHECK_MODULES:
        clash = set(q) & set(m.CHECKS)
        if clash:
            raise ValueError(f"check names registered twice: {sorted(clash)}")
        q.update({k: v[0] for k, v in m.CHECKS.items()})
    return {k: _with_defaults(v) for k, v in q.items()}


def all_oracles() -> dict:
    o = {}
    o.update(model_sql())
    for m in CHECK_MODULES:
        o.update({k: v[1] for k, v in m.CHECKS.items() if v[1]})
    return o

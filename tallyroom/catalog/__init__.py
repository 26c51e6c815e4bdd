"""Registered queries over the given tables."""

from importlib import import_module

_MODULES = ["event_queries", "learner_queries", "table_queries", "text_queries", "retrieval_queries"]


def _load():
    from . import registry

    for name in _MODULES:
        import_module(f"{__name__}.{name}")
    return registry


def all_queries() -> dict:
    return dict(_load().QUERIES)


def all_oracles() -> dict:
    return dict(_load().ORACLES)

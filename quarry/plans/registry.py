"""All registered queries and their oracle SQL, in one place."""

from __future__ import annotations

from . import catalog, oracles


def all_queries():
    from . import ml_catalog, model_catalog, source_catalog, stream_catalog  # noqa: F401  (register their keys)
    return dict(catalog.REGISTRY)


def all_oracles():
    from . import ml_catalog, model_catalog, source_catalog, stream_catalog
    out = dict(oracles.ORACLES)
    out.update(ml_catalog.ORACLES)
    out.update(model_catalog.ORACLES)
    out.update(source_catalog.ORACLES)
    out.update(stream_catalog.ORACLES)
    keys = set(all_queries())
    return {k: v for k, v in out.items() if k in keys}

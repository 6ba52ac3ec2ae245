"""Catalogue of registered queries, one module per theme."""

from importlib import import_module

THEMES = ["prepare", "profile", "rules", "evaluate", "neighbors", "cluster_scores", "clustering", "models"]


def load_catalog():
    from tabforge.catalog import registry

    for theme in THEMES:
        import_module(f"tabforge.catalog.{theme}")
    return registry.QUERIES, registry.ORACLES

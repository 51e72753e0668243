"""Relational operators: DataFrame(s) in, DataFrame out."""

from . import aggregates, filters, joins, layout, sets

__all__ = ["aggregates", "filters", "joins", "layout", "sets"]

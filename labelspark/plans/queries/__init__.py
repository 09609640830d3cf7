"""Registered queries, by area.  Importing a module registers its queries."""

from labelspark.plans.queries import discovery, filters, labels, ranges, requests, routing, streams, values

__all__ = ["discovery", "filters", "labels", "ranges", "requests", "routing", "streams", "values"]

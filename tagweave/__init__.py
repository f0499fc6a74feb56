"""Post preparation and tag mining as Spark DataFrame transformations."""

from tagweave.options import Options

__all__ = ["Options"]

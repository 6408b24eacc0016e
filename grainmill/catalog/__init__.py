"""The operators as queries over the test tables, each with its SQL where SQL can express it."""

from grainmill.catalog.registry import REGISTRY
from grainmill.catalog import aggregating, cleaning, closed_forms, columns, exploring, missing, modelling, selecting, storing  # noqa: F401  (they register)

__all__ = ["REGISTRY"]

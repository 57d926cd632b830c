"""All registered queries. Importing the package fills the registry."""

from querybook import aggregates, classifier, cleaning, jsonlines, quality, serving  # noqa: F401
from querybook.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

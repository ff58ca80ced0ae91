"""Imports every query module, which registers its queries."""

from kinfold.queries import entities, resolving, routing, sources  # noqa: F401

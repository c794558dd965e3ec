"""Registered queries over the given tables."""

from ascentframe.queries import checks, cleaning, files, longtable, places, profiles, serving, storage  # noqa: F401
from ascentframe.queries.registry import QUERIES, TWINS  # noqa: F401

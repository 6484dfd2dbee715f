"""Queries over the driver tables, built from the operators."""

from tessera.plans import association, curves, ladders, lines, membership, pipelines, records, relations  # noqa: F401

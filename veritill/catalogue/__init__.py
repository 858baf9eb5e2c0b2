"""Registered queries: every operator over the given tables, with an independent SQL check."""

from veritill.catalogue.registry import oracles, registered

__all__ = ["oracles", "registered"]

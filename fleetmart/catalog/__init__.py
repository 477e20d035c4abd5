"""Registered queries: every operator run over the given tables, with equivalent SQL."""

from fleetmart.catalog import checks, landing, positions, registers, sources  # noqa: F401
from fleetmart.catalog.registry import CATALOG  # noqa: F401

"""Layer operators: bronze, silver, gold, slices, models, monitoring,
alerts, registry and checks.  Each is a DataFrame -> DataFrame function."""

from demandlake.operators import alerts, bronze, checks, gold, models, monitoring, registry, silver, slices

__all__ = ["alerts", "bronze", "checks", "gold", "models", "monitoring", "registry", "silver", "slices"]

"""Fixtures from the driver tables, the two flows, and the registered
query catalogue with its SQL oracles."""

"""Query plans: the registered query catalogue and its SQL oracles."""

from lotcast.plans.catalogue import QUERIES
from lotcast.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]

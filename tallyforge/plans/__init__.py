"""The named queries of the listing operators, with SQL oracles."""

from tallyforge.plans import catalog, records, sites, systems
from tallyforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalog", "records", "sites", "systems"]

"""The feed tables derived from the driver's tables, the queries over them, and their SQL oracles."""

from workload import addresses, card, customers, direct_debit, merchants, quarantine, run_log
from workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "addresses",
    "card",
    "customers",
    "direct_debit",
    "merchants",
    "quarantine",
    "run_log",
]

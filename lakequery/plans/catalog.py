"""All registered plans."""

from lakequery.plans import encoding, inference, logs, results, transfer
from lakequery.plans.registry import ORACLES, PLANS

MODULES = (encoding, inference, logs, results, transfer)

__all__ = ["MODULES", "ORACLES", "PLANS"]

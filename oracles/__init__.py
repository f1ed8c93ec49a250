"""SQL counterparts of the registered queries."""

from oracles.statements import ORACLES

__all__ = ["ORACLES"]

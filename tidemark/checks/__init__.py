from tidemark.checks import contracts, datasets, flow, landing, scalars  # noqa: F401
from tidemark.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

from . import catalogs, changes, outputs, projections, pulls, scans
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalogs", "changes", "outputs", "projections", "pulls", "scans"]

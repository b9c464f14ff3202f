"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import os

# The matrices multiplied here are small, and tasks run side by side: threads of their own would only get in each other's way.
os.environ.setdefault("OMP_NUM_THREADS", "1")

from . import queries  # noqa: E402
from .base import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES", "queries"]

"""Python functions that run on executors."""

from __future__ import annotations

import sys


def ship(module: str) -> None:
    """Send a module's functions to Python workers by value, so that executors need not have the package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])

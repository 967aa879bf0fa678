"""Functions that run in Python workers."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def runs_in_workers(module_name: str) -> None:
    """Send the functions of a module to executors by value, so they need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])

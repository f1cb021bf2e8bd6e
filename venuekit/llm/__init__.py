"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to Python workers by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from venuekit.llm.registry import ORACLES, QUERIES  # noqa: E402

from venuekit.llm import queries  # noqa: E402, F401  (importing registers the queries)

__all__ = ["ORACLES", "QUERIES"]

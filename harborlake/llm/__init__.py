"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

from harborlake.llm.oracles import ORACLES
from harborlake.llm.queries import QUERIES

# Tasks carry the functions of this package with them, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]

"""Operators of a training-data pipeline, one module each, with their named queries."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value: those need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

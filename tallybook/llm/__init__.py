"""Operators of a training-data pipeline over text and vector tables."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to executors by value, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline, one module for each."""

import sys

from pyspark import cloudpickle

# Functions sent to the executors travel by value: workers need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Telemetry analytics for chess-engine experiments on Apache Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to the executors travel by value: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Urban-greening and property analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a job needs no package install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

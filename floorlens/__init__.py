"""Daily per-unit performance statistics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python on the executors travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Field-scan analytics on Spark: time alignment, slicing, tracking, counting, ledgers and evaluation as DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

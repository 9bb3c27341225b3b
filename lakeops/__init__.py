"""Everyday table jobs on stock Spark: scan, clean, query, change, version and model."""

import sys

from pyspark import cloudpickle

# Python functions that run in executors travel with the job, so a cluster needs no install of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

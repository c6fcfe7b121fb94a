"""Voxlens: customer voice analytics (comments and reviews) as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators that prepare text corpora for training."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

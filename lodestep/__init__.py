"""Product and growth analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors by value, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

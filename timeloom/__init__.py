"""timeloom: a Spark-native engine for vintage-tracked time series and text corpora."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel with their tasks by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

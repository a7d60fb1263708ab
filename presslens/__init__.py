"""presslens: news topic classification and text analytics on Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions of this package travel to the executors by value; it need not be installed there.
register_pickle_by_value(sys.modules[__name__])

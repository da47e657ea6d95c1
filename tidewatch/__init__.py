"""Security telemetry analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# the few Pandas functions travel to the executors by value, so nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

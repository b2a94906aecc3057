"""Spark-native order and clickstream analytics: change events to clean tables, marts, live views and models."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need not have this package installed: functions sent to Python workers carry their own code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

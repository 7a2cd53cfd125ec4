"""Spark-native profiling, cleansing and layered loading of messy delimited exports."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their plan: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

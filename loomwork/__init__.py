"""loomwork: a PySpark-native engine for analysing and preparing document corpora."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of the library travel to the executors by value: they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

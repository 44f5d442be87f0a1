"""Marlstone: a PySpark-native engine for curating data sets from web pages."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a cluster needs no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

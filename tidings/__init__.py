"""Tidings: a Spark-native engine that turns captured news pages into periodic digests."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

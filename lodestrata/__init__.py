"""Spark-native engine for building and querying an evidence registry of models and papers."""

import sys

from pyspark import cloudpickle

# Workers get the engine's functions by value, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

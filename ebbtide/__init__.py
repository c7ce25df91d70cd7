"""Spark-native customer-attrition analytics and model monitoring."""

import sys

from pyspark import cloudpickle

# Ship the few Python helpers inside their tasks, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

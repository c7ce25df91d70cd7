"""Operators for training-data pipelines, their queries and SQL; nothing else imports this package."""

import sys

from pyspark import cloudpickle

# Functions travel with their code, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

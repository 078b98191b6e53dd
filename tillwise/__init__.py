"""Retail analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Pandas functions travel to the executors with their code, so that no executor needs a
# copy of this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Catalog and traffic analytics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job; workers need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

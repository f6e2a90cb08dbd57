"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Worker functions travel with their code, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

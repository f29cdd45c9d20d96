"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Code that runs in tasks travels with them, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

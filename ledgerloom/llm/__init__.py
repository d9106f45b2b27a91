"""Operators for training-data pipelines; the rest of the library does not import this package.

Task functions travel to the executors by value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training-data pipelines: one module for each, general interfaces.

Functions of this package travel to the executors by value, so that a cluster needs no
copy of it on its workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

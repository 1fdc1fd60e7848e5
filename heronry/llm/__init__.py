"""Operators of a training-data pipeline over tables of texts.

Functions of this package travel to the executors by value, so nothing need be installed there but the
libraries they use.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

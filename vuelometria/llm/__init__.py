"""Operators for training data: filters, near copies, mixtures, shards, extraction, chat formats."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel whole, so the executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

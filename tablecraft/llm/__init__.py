"""Operators for training-data pipelines over tables of documents and pages.

Functions that run in Python workers are pickled by value, so that executors need
the libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for building training data from text, vectors and web pages.

Functions that run in Python workers are shipped by value, so that workers need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

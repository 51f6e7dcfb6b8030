"""Operators for preparing training text, apart from the rest of the library.

Functions that run in Python workers are shipped by value, so that a cluster
needs no copy of this package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training text."""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value, so executors need no copy of the library;
# broadcast values are pickled by reference and hold plain arrays only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

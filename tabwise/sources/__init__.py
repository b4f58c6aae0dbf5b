"""Readers and writers.

Task code defined here is pickled by value, so workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tabwise.sources import readers, writers  # noqa: E402,F401

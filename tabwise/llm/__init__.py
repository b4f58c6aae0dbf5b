"""Operators for preparing training data: scoring, scans, deduplication, mixing.

Nothing else in the library imports this package. Task code defined here is
pickled by value, so workers need only numpy, pandas, pyarrow, pyahocorasick and
tokenizers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

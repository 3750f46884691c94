"""Operators for preparing training data: search, dedup, scoring, mixing, packing.

Nothing else in the library imports this subpackage. Its functions travel to the
executors by value, so a cluster needs numpy, pandas and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

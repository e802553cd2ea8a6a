"""Operators for preparing training text: deduplication, filters, archives and packing."""

import sys

from pyspark import cloudpickle

# Functions travel to executors whole, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

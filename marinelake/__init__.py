"""PySpark-native processing of oceanographic sensor data."""

import sys

from pyspark import cloudpickle

from marinelake.options import JobOptions, ProviderRule
from marinelake.session import configure, scratch_dir

# Functions shipped to Python workers travel by value, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["JobOptions", "ProviderRule", "configure", "scratch_dir"]

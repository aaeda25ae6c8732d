"""Identity analytics on Spark DataFrames.

Functions that run in Python workers travel to them by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

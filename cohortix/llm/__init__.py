"""Operators of a training-data pipeline (packing, LM scoring, PII, mixing, joins, classifiers, media, HTML, quality).

Nothing else in the library imports this subpackage.  Its functions travel to
Python workers by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

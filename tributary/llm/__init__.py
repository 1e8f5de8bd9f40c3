"""Operators for large text corpora used as training data. Nothing else in the library imports this.

Functions that run in tasks are shipped whole, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

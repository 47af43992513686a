"""Operators for large text corpora.

Functions of this package that run in Python workers travel with the job by value; executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

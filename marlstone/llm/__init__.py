"""Operators for preparing training text; nothing else in the library imports this package.

Functions that run in Spark's Python workers travel with the job, so this package need not be installed
on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

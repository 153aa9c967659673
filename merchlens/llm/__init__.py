"""Operators of a training-data pipeline; nothing outside this package imports it.

Functions that run in Python workers travel with the job instead of being imported there, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

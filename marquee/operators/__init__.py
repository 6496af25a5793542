"""Operators: functions from DataFrames to DataFrames.

Functions that run inside Python tasks (``kmeans``, ``silhouette``) are shipped
by value, so executors need numpy and pyarrow but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

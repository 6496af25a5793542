"""Operators for preparing language-model training data at scale.

Every operator is a function over DataFrames; ``queries.py`` holds the thin
registered queries on top of them. Nothing outside this package imports it.
Functions that run inside Python tasks are shipped by value, so executors
need numpy and pyarrow but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

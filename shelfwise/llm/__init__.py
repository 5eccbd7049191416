"""Operators of a large-scale training-data pipeline, on Spark DataFrames.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries`` holds the thin
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the task, so executors need no
# copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline.

Functions of this package travel to executors by value, so executors need no
copy of the repository on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline: one module per operator, and their queries and SQL.

Functions that run on executors are sent there by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

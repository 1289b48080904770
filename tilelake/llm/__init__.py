"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions of this folder that run in tasks travel to the executors by value, so executors
need numpy, pyarrow, regex and xxhash but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

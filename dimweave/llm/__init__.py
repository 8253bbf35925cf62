"""Operators for preparing training data; nothing else in the library imports this subpackage.

Functions of this subpackage travel to executors whole, so that a job needs no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

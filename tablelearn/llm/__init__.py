"""Operators for preparing training text.

Nothing outside this folder imports it.  Functions that run inside tasks are
pickled by value, so the workers of a cluster need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

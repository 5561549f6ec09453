"""Training-data operators: one module per operator, ``registry`` for the queries built on them.

Functions that run inside tasks are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

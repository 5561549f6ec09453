"""Functions of this package that run inside tasks are pickled by value, so workers need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

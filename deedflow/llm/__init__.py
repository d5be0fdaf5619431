"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions along, so that executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

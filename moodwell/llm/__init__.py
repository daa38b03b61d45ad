"""Operators for preparing language-model training data; nothing else in the library needs them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

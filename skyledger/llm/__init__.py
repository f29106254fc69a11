"""Operators of a training-data pipeline. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

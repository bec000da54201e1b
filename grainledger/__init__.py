"""Operations analytics on Spark: canonical facts from messy feeds, as lazy DataFrame functions."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python tasks travel by value, so executors need not have this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

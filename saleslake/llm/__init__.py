"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# the functions of this subpackage travel inside the UDFs, so workers need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that these need
# Python and the public libraries but no copy of the code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training-data pipelines. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Task code travels by value, so workers do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

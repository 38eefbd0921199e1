"""Operators for preparing language-model training data, and the queries that run them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so that they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

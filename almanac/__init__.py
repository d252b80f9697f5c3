"""Dated news text and daily prices to return-prediction features, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Training-data operators. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so that a cluster
# needs no copy of it on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

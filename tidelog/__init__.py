"""Change-data-capture on Spark: binary replication logs to typed changes and ordered SQL."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

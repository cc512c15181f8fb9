"""paystrata: payment and transaction intelligence as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need neither
# an installed copy of the package nor a search path to it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

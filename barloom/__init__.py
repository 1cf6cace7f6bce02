"""barloom: equity-market analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry the package's code with them, so that executors
# need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

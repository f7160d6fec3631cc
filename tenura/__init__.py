"""People-attrition analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run in Python workers travel with the job, so that no executor
# needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Table-scale statistical operators on Spark DataFrames."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Ship this package's functions inside the tasks, so that executors need no
# installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

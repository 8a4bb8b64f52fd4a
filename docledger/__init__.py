"""docledger: auditable document analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python code that runs on executors travels with the plan, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

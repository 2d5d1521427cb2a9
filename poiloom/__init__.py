"""Point-of-interest cleaning on Spark, with a training-data toolkit beside it in ``poiloom.llm``.

Functions of this package that run in Python workers are sent by value, so a cluster
needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

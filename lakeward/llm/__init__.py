"""Training-data operators on Spark.

Task functions of these modules run in Python workers; they are pickled by
value, so executors need numpy and pyarrow but not this package on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

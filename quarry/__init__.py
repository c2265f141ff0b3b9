"""quarry: a Spark-native document-corpus analytics engine.

Functions shipped to Python workers (the Porter pandas UDF, the vector
top-k ``mapInPandas`` body) are pickled by value, so executors need only
PySpark, numpy and pandas -- not this package -- on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

"""Language-model training data on Spark.

Functions of this package that run inside Python UDFs are pickled by value, so
executors need no copy of the package on their path (nothing to install or
ship with ``--py-files``)."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing language-model training data at cluster scale."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

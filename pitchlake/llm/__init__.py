"""Operators for preparing language-model training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# task functions travel with their code, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

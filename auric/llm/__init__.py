"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its functions are
shipped to the executors by value, so a cluster needs no copy of the
repository on its Python path.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

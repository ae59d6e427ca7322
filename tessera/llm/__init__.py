"""Operators of a training-data pipeline over text corpora.

Every operator is a function on DataFrames; ``queries`` holds the registered
queries (one per operator, with production parameters).  Nothing outside this
package imports it.

Functions of this package that run inside tasks are pickled by value, so
executors need no copy of it.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

"""Operators of a training-data pipeline: near duplicates, filters, mixing, tokens.

Nothing else in the library imports this subpackage. Every operator selects the
columns it needs by name and returns new ones beside the key it was given, so
further columns of the input, whatever their names, neither matter nor survive.

The functions that run inside tasks travel by value, so executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

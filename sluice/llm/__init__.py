"""Operators for preparing training text.

Python functions of this package travel to the workers by value, so executors need
the third-party libraries but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

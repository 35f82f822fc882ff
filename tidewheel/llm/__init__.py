"""Operators for preparing language-model training data. Nothing outside this package imports it.

Functions that run in tasks travel with the plan, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

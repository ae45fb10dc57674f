"""Operators for preparing language-model training data, with their registered queries.

Functions of this package travel to the executors by value, so executors need none of it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

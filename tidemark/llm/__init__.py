"""Operators for preparing language-model training data.

Every operator reads the columns it names and ignores all others, whatever they are called.
Functions that run on executors travel by value, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

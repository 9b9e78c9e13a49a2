"""Operators that prepare text, vectors and conversations for training.

Tasks take the functions of this subpackage along by value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

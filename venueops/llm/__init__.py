"""Operators for the preparation of training data; see ``queries`` for how each is bound to the tables.

Nothing outside this folder imports it. Functions that run inside Python workers are pickled by value, so
that executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

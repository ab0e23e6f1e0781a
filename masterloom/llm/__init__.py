"""Operators for preparing training data at corpus scale.

Each module is one operator with its own general interface; ``queries`` applies each
of them to its whole table.  Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

# Functions for the executors travel whole: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

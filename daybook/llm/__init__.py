"""Operators for preparing training data; nothing else in the package imports this.

Functions of this folder that run in tasks are sent to the executors by value, so that a cluster needs
no copy of the package on its workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training data, each a set of Spark jobs.

Nothing outside this subpackage imports it.  Functions that run inside
Python tasks are pickled by value, so executors need no copy of the package
on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators that prepare text corpora for model training.

Their task functions travel to the executors with the plan, so these need the
libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

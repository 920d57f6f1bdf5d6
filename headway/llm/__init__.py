"""Training-data operators: tokenising, scoring, sharding, filtering, joining, packing.

Functions that run inside tasks are shipped by value, so executors need only
the third-party libraries, not a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

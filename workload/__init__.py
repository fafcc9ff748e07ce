"""Driver queries: every operator on inputs derived from the given tables, next to its reference SQL."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""filedrop: gzip fixed-width file drops processed as Spark DataFrames.

Functions that run inside Python workers travel by value with the job, so a cluster needs no copy of this
package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

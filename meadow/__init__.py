"""meadow: community-abundance analytics as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

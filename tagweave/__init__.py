"""tagweave: image-text tagging, retrieval and evaluation as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Kernels travel to the workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Document, conversation and evaluation analytics expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the tasks, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

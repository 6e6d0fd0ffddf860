"""Supervised classification on tables, expressed as Spark DataFrame work."""

import sys

from pyspark import cloudpickle

# Ship the helpers that run inside tasks with the tasks, so that executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

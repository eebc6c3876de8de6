"""Durable-workflow analytics and resumable batch jobs on PySpark."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: its functions and classes travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

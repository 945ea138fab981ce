"""Dialogue, retrieval and agent-memory data work as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

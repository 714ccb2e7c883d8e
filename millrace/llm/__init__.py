"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import millrace

# Executors get the code with the tasks, without an installed package.
cloudpickle.register_pickle_by_value(millrace)

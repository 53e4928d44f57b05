"""Operators for training-data pipelines; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# tasks get the code of this package with the plan, so executors need not have it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

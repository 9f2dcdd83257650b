"""Operators of a training-data pipeline over text, pages and vectors."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job itself, so a
# cluster needs no copy of the repository on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

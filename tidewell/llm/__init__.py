"""Operators for training data at scale: deduplication, language, quality, mixing, tokens, scoring and sharding."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

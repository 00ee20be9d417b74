"""Operators for training-data corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Workers get this package's functions with their tasks, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

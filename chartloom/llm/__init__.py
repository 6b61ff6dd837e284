"""Corpus operators for training data: de-duplication, filtering, scoring, mixing and packing."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with their code, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
